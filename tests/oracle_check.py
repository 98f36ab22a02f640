"""Run registered queries beside their SQL and compare: names, types, rows. ``python tests/oracle_check.py [names]``"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return "null"
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return repr(value)


def _kind(column: pd.Series) -> str:
    # A column without a value has no type to compare in pandas.
    if column.isna().all():
        return "null"
    # The two engines hand naive timestamps over in different units.
    return "timestamp" if str(column.dtype).startswith("datetime64") else str(column.dtype)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    names = sorted(frame.columns)
    return sorted(zip(*[[_cell(v) for v in frame[n]] for n in names]))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    # Whole numbers with missing values: one side hands them over as floats, the other in a type of its own.
    whole = [n for n in sql_frame.columns if str(sql_frame[n].dtype) == "Int64"]
    sql_frame = sql_frame.astype({n: "float64" for n in whole})
    kinds = [(n, _kind(spark_frame[n]), _kind(sql_frame[n])) for n in sorted(spark_frame.columns)]
    left, right = rows(spark_frame), rows(sql_frame)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    odd = [k for k in kinds if k[1] != k[2] and len(spark_frame)]
    return f"types {odd}" if odd else None


def main(names: list[str]) -> int:
    import __spark_entry__ as entry
    from gustline.session import local_session

    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(), connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(queries):
        begin = time.time()
        try:
            frame = queries[name](spark, folder).toPandas()
            middle = time.time()
            if name in sql:
                verdict = difference(frame, con.execute(sql[name]).df())
            else:
                verdict = None if len(frame) else "no rows"
            note = verdict or f"ok ({len(frame)} rows{'' if name in sql else ', rows only'})"
            print(f"{name}: {note} spark {middle - begin:.1f}s sql {time.time() - middle:.1f}s", flush=True)
        except Exception as error:  # noqa: BLE001
            verdict = str(error)
            print(f"{name}: FAILED {type(error).__name__} {verdict[:700]}", flush=True)
        failed += verdict is not None
    print(f"{failed} of {len(names or queries)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
