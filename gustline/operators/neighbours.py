"""Nearest present value before and after each row of a keyed, ordered series.

Filling and interpolation need the last present value at or before a row and the first one after it.
One window per station would put a whole station into one task, so the series is cut into chunks of
fixed length: a window inside each ``(keys, chunk)`` finds the neighbours within the chunk, and one small
row per chunk carries the last and first present values over to the other chunks. The heavy part is
spread by chunk, only the per-chunk rows are ordered by station.

Contract: one row per ``(keys, position)``; the position is a whole number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = "__chunk"
NEXT_POSITION = "__next_position"
FIRST_POSITION = "__first_position"
# Rows that a task sorts, on average: some 700 bytes each with ten columns, in both orders together.
TASK_ROWS = 200_000


def before(column: str) -> Column:
    """Struct (at, value): last present value at or before the row."""
    return F.col(f"__before_{column}")


def after(column: str) -> Column:
    """Struct (at, value): first present value after the row."""
    return F.col(f"__after_{column}")


def helper_columns(columns: Sequence[str]) -> list[str]:
    names = [CHUNK, NEXT_POSITION, FIRST_POSITION]
    for c in columns:
        names += [f"__before_{c}", f"__after_{c}"]
    return names


def placed(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Rows that belong to a series: every key and the position are known."""
    for c in (*keys, position):
        df = df.where(F.col(c).isNotNull())
    return df


def _pair(at: str, value: str) -> str:
    return f"CASE WHEN {at} IS NOT NULL AND {value} IS NOT NULL THEN struct({at} AS at, {value} AS value) END"


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _chunks(spread: DataFrame, group: Sequence[str], aggregates: Sequence[Column], used: Sequence[str]) -> DataFrame:
    """Aggregate per chunk without giving up columns.

    Columns the aggregates do not use would be pruned from this branch, and Spark would run everything
    below the exchange twice, once per set of columns. Reading them (the condition always holds) keeps the
    two exchanges equal and so shared.
    """
    others = [c for c in spread.columns if c not in used and c not in group]
    if not others:
        return spread.groupBy(*group).agg(*aggregates)
    read = F.expr(f"count(nullif(xxhash64({_names(others)}), 0)) AS __read")
    return spread.groupBy(*group).agg(*aggregates, read).where("__read >= 0").drop("__read")


def tasks_for(df: DataFrame) -> int | None:
    """Tasks among which a written table is dealt so that what one of them sorts is bounded, however large the table; None if
    a single task could hold it."""
    rows = df.count()
    return max(-(-rows // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism) if rows > TASK_ROWS else None


def with_neighbours(df: DataFrame, position: str, columns: Sequence[str], keys: Sequence[str],
                    chunk: int, tasks: int | None = None) -> DataFrame:
    """Add the neighbour structs, the next row's position and the series' first position. ``tasks``: how many the rows are dealt
    to (:func:`tasks_for`), the session's number unless given."""
    keys = list(keys)
    # Both branches below start from this one exchange. The join would push its null checks into one branch
    # only and so make the exchanges differ; stated here, they are part of both.
    spread = placed(df, keys, position).withColumn(CHUNK, F.floor(F.col(position) / F.lit(chunk)))
    spread = spread.where(F.col(CHUNK).isNotNull())
    spread = spread.repartition(*keys, CHUNK) if tasks is None else spread.repartition(tasks, *keys, CHUNK)

    present = {c: f"CASE WHEN `{c}` IS NOT NULL THEN `{position}` END" for c in columns}
    edges = _chunks(spread, [*keys, CHUNK], [
        F.expr(f"min(`{position}`) AS __low"),
        *[F.expr(text) for c in columns for text in (
            f"max({present[c]}) AS `__last_at_{c}`", f"max_by(`{c}`, {present[c]}) AS `__last_{c}`",
            f"min({present[c]}) AS `__first_at_{c}`", f"min_by(`{c}`, {present[c]}) AS `__first_{c}`")],
    ], [position, *columns])
    rising = f"PARTITION BY {_names(keys)} ORDER BY {CHUNK}"
    strictly_before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    carries = edges.selectExpr(
        *[f"`{k}`" for k in [*keys, CHUNK]],
        f"lead(__low) OVER ({rising}) AS __next_low",
        f"min(__low) OVER ({rising} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {FIRST_POSITION}",
        *[f"last({_pair(f'`__last_at_{c}`', f'`__last_{c}`')}, true) OVER ({rising} {strictly_before}) "
          f"AS `__carry_before_{c}`" for c in columns],
        *[f"last({_pair(f'`__first_at_{c}`', f'`__first_{c}`')}, true) OVER ({rising} DESC {strictly_before}) "
          f"AS `__carry_after_{c}`" for c in columns],
    )

    local = f"PARTITION BY {_names([*keys, CHUNK])} ORDER BY `{position}`"
    so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    # The later neighbour is read in falling order: a frame to the end of the partition would be quadratic.
    within = spread.selectExpr(
        "*", f"lead(`{position}`) OVER ({local}) AS {NEXT_POSITION}",
        *[f"last({_pair(f'`{position}`', f'`{c}`')}, true) OVER ({local} {so_far}) AS `__before_{c}`" for c in columns],
        *[f"last({_pair(f'`{position}`', f'`{c}`')}, true) OVER ({local} DESC {strictly_before}) AS `__after_{c}`" for c in columns])
    # Joined last, so that no sort holds what a chunk is told, and by merging: the rows lie by chunk already, and no task holds
    # a table of its chunks, which may be as many as its rows.
    joined = within.join(carries.hint("merge"), [*keys, CHUNK])
    return joined.selectExpr(
        *[f"`{c}`" for c in df.columns], CHUNK, FIRST_POSITION, f"coalesce({NEXT_POSITION}, __next_low) AS {NEXT_POSITION}",
        *[f"coalesce(`__before_{c}`, `__carry_before_{c}`) AS `__before_{c}`" for c in columns],
        *[f"coalesce(`__after_{c}`, `__carry_after_{c}`) AS `__after_{c}`" for c in columns],
    )
