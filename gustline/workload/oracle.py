"""SQL of the shared steps, written as chains of common table expressions for DuckDB."""

from __future__ import annotations

from gustline.workload.views import FIRES_SQL, STATIONS_SQL, obs_sql

MEANS = ("tmpf", "dwpf", "relh", "sknt", "vsby", "feel")
MAIN = ("tmpf", "dwpf", "relh", "sknt", "skyc1", "skyl1", "feel")
ALL = ("tmpf", "dwpf", "relh", "drct", "sknt", "p01i", "vsby", "gust", "skyc1", "skyl1", "feel")
CLEAN_ALL = ("tmpf", "dwpf", "relh", "sknt", "p01i", "vsby", "gust", "skyc1", "skyl1", "feel", "drct_sin", "drct_cos")
CODE = ("CASE replace(skyc1, ' ', '') WHEN 'CLR' THEN 0e0 WHEN 'FEW' THEN 1e0 WHEN 'SCT' THEN 2e0 "
        "WHEN 'BKN' THEN 3e0 WHEN 'OVC' THEN 4e0 WHEN 'VV' THEN 5e0 END")


def r6(expression: str) -> str:
    """Six digits; the small shift keeps exact halves from depending on the last bit of a sum."""
    return f"(floor(({expression}) * 1e6 + 501e-3) / 1e6)"


def chain(*steps: tuple[str, str], final: str) -> str:
    """A step that unites with itself is left to the recursion, the others are computed once."""
    parts = [f"{name} AS {'' if f'FROM {name} WHERE' in text else 'MATERIALIZED '}({text})" for name, text in steps]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + final


def observations(station: str = "type", time: str = "exact") -> tuple[str, str]:
    return "obs", obs_sql(station, time)


STATIONS = ("stations", STATIONS_SQL)
FIRES = ("fires", FIRES_SQL)


def encoded(columns) -> tuple[str, str]:
    def one(c: str) -> str:
        if c == "skyc1":
            return f"{CODE} AS skyc1"
        if c in ("p01i", "gust"):
            return f"CASE WHEN {c} > 0 THEN 1e0 ELSE 0e0 END AS {c}"
        return c
    return "enc", f"SELECT network, station, valid, {', '.join(map(one, columns))} FROM obs"


def buckets(columns, source: str = "enc", label: str = "date_trunc('hour', valid)") -> tuple[str, str]:
    def one(c: str) -> str:
        rule = "avg" if c in MEANS else "max" if c in ("p01i", "gust") else "median"
        return f"{rule}({c}) AS {c}"
    return "hourly", (f"SELECT network, station, ({label})::TIMESTAMP AS valid, {', '.join(map(one, columns))} "
                      f"FROM {source} GROUP BY 1, 2, 3")


#: Rows with the first time of their series, from which some buckets are counted.
FROM_FIRST = "(SELECT *, min(valid) OVER (PARTITION BY network, station) AS first FROM enc) e"


def grid(columns, steps: str = "generate_series(min(valid), max(valid), INTERVAL 1 HOUR)") -> tuple[str, str]:
    return "grid", (
        f"SELECT g.network, g.station, g.valid, {', '.join('h.' + c for c in columns)} FROM ("
        f"SELECT network, station, unnest({steps})::TIMESTAMP AS valid "
        "FROM hourly GROUP BY 1, 2) g LEFT JOIN hourly h USING (network, station, valid)")


UP = "(PARTITION BY network, station ORDER BY valid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
DOWN = "(PARTITION BY network, station ORDER BY valid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def ffill(x: str) -> str:
    return f"last_value({x} IGNORE NULLS) OVER {UP}"


def bfill(x: str) -> str:
    return f"first_value({x} IGNORE NULLS) OVER {DOWN}"


def both_fills(x: str) -> str:
    return f"coalesce({ffill(x)}, {bfill(x)})"


def linear(c: str) -> str:
    at = f"CASE WHEN {c} IS NOT NULL THEN epoch(valid) END"
    t0, v0, t1, v1 = ffill(at), ffill(c), bfill(at), bfill(c)
    return f"CASE WHEN {c} IS NOT NULL THEN {c} ELSE coalesce({v0} + ({v1} - {v0}) / ({t1} - {t0}) * (epoch(valid) - {t0}), {v0}, {v1}) END"


def cleaned(columns) -> tuple[str, str]:
    def one(c: str) -> list[str]:
        if c in MEANS:
            return [f"{linear(c)} AS {c}"]
        if c in ("p01i", "gust"):
            return [f"coalesce({c}, 0e0) AS {c}"]
        if c == "skyc1":
            whole = "CASE WHEN skyc1 = floor(skyc1) AND skyc1 BETWEEN 0 AND 5 THEN skyc1 END"
            return [f"{both_fills(whole)} AS skyc1"]
        if c == "drct":
            turn = f"2 * pi() * ({both_fills('drct')}) / 360"
            return [f"sin({turn}) AS drct_sin", f"cos({turn}) AS drct_cos"]
        return [f"{both_fills(c)} AS {c}"]
    cells = ", ".join(x for c in columns for x in one(c))
    return "clean", f"SELECT network, station, valid, {cells} FROM grid"


def clean_steps(columns=MAIN, station: str = "type", time: str = "exact") -> list[tuple[str, str]]:
    return [observations(station, time), encoded(columns), buckets(columns), grid(columns), cleaned(columns)]


def long_rows(columns=MAIN, source: str = "clean") -> tuple[str, str]:
    parts = " UNION ALL ".join(f"SELECT network, station, valid, '{c}' AS \"column\", {c} AS value FROM {source}" for c in columns)
    return "long", parts


# Day rows with 24 slots; the last row is filled up with its last value.
SPLIT = [
    ("placed", """SELECT network, station, "column", valid, value,
        CAST(date_diff('hour', min(valid) OVER (PARTITION BY network, station), valid) AS BIGINT) AS place FROM long"""),
    ("short", """SELECT network, station, "column", place // 24 AS row, min(valid) AS day,
        list(value ORDER BY place) AS vals FROM placed GROUP BY ALL"""),
    ("split", """SELECT network, station, "column", day,
        list_concat(vals, list_transform(range(24 - len(vals)), lambda i: vals[-1])) AS vals FROM short"""),
    ("cells", """SELECT network, station, "column", day, s.slot, vals[s.slot + 1] AS value
        FROM split, (SELECT unnest(range(24)) AS slot) s"""),
]


def lowess_steps(n: int, k: int, source: str = "cells", name: str = "smooth") -> list[tuple[str, str]]:
    """Four passes over a constant window table; (slot, value) per series in, (slot, smooth) out."""
    half = k // 2
    steps = [
        ("win", f"""SELECT i, j, CASE WHEN d <= 1e-3 * r THEN 1e0 WHEN d > 999e-3 * r THEN 0e0
            ELSE power(1 - power(d / r, 3), 3) END AS w FROM (
            SELECT i, s + o AS j, abs(i - s - o) * 1e0 AS d, greatest(i - s, s + {k - 1} - i) * 1e0 AS r FROM (
              SELECT i, least(greatest(i - {half}, 0), {n - k}) AS s FROM (SELECT unnest(range({n})) AS i) a) b,
              (SELECT unnest(range({k})) AS o) c) d"""),
        ("p0", f"""SELECT network, station, "column", day, slot, value, 1e0 AS rw FROM {source} WHERE value IS NOT NULL"""),
    ]
    for t in range(4):
        steps.append((f"m{t}", f"""SELECT p.network, p.station, p."column", p.day, i, sum(w * rw) AS sw,
            sum(w * rw * j) / nullif(sum(w * rw), 0) AS xb, sum(w * rw * value) / nullif(sum(w * rw), 0) AS yb
            FROM p{t} p JOIN win ON j = slot GROUP BY ALL"""))
        steps.append((f"f{t}", f"""SELECT m.network, m.station, m."column", m.day, m.i AS slot, any_value(m.sw) AS sw,
            any_value(m.yb) + any_value(m.i - m.xb) * CASE WHEN sum(w * rw * power(j - m.xb, 2)) / any_value(m.sw) > 1e-12
              THEN sum(w * rw * (j - m.xb) * p.value) / sum(w * rw * power(j - m.xb, 2)) ELSE 0e0 END AS fit
            FROM m{t} m JOIN win ON win.i = m.i JOIN p{t} p ON p.slot = j AND p.network = m.network AND p.station = m.station
              AND p."column" = m."column" AND p.day = m.day GROUP BY ALL"""))
        steps.append((f"e{t}", f"""SELECT p.network, p.station, p."column", p.day, p.slot, p.value,
            CASE WHEN f.sw > 0 THEN f.fit ELSE p.value END AS fit,
            abs(p.value - CASE WHEN f.sw > 0 THEN f.fit ELSE p.value END) AS e
            FROM p{t} p JOIN f{t} f USING (network, station, "column", day, slot)"""))
        steps.append((f"p{t + 1}", f"""SELECT network, station, "column", day, slot, value, fit,
            CASE WHEN s > 0 THEN CASE WHEN e / s >= 1 - 1e-9 THEN 0e0 ELSE power(1 - power(e / s, 2), 2) END
                 WHEN e > 0 THEN 0e0 ELSE 1e0 END AS rw
            FROM (SELECT *, 6 * median(e) OVER (PARTITION BY network, station, "column", day) AS s
              FROM (SELECT * REPLACE (CASE WHEN e <= 1e-10 * max(abs(value)) OVER (PARTITION BY network, station, "column", day)
                THEN 0e0 ELSE e END AS e) FROM e{t}) z) q"""))
    steps.append((name, """SELECT network, station, "column", day, slot, value, fit AS smooth FROM p4"""))
    return steps


def long_lowess_steps(frac: str, source: str, name: str = "smooth") -> list[tuple[str, str]]:
    """As ``lowess_steps``, for series (network, station, slot, value) of any length without missing slots."""
    steps = [
        ("shape", f"SELECT network, station, count(*) AS n, least(count(*), CAST(floor(count(*) * {frac} + 1e-10) AS BIGINT)) AS k FROM {source} GROUP BY ALL"),
        ("win", f"""SELECT network, station, i, j, CASE WHEN d <= 1e-3 * r THEN 1e0 WHEN d > 999e-3 * r THEN 0e0
            ELSE power(1 - power(d / r, 3), 3) END AS w FROM (
            SELECT network, station, i, s + o AS j, abs(i - s - o) * 1e0 AS d, greatest(i - s, s + k - 1 - i) * 1e0 AS r FROM (
              SELECT network, station, slot AS i, k, least(greatest(slot - k // 2, 0), n - k) AS s, unnest(range(k)) AS o
              FROM {source} JOIN shape USING (network, station)) b) c"""),
        ("p0", f"SELECT network, station, slot, value, 1e0 AS rw FROM {source}"),
    ]
    for t in range(4):
        steps.append((f"m{t}", f"""SELECT p.network, p.station, i, sum(w * rw) AS sw,
            sum(w * rw * j) / nullif(sum(w * rw), 0) AS xb, sum(w * rw * value) / nullif(sum(w * rw), 0) AS yb
            FROM p{t} p JOIN win ON win.network = p.network AND win.station = p.station AND j = slot GROUP BY ALL"""))
        steps.append((f"f{t}", f"""SELECT m.network, m.station, m.i AS slot, any_value(m.sw) AS sw,
            any_value(m.yb) + any_value(m.i - m.xb) * CASE WHEN sum(w * rw * power(j - m.xb, 2)) / any_value(m.sw) > 1e-12
              THEN sum(w * rw * (j - m.xb) * p.value) / sum(w * rw * power(j - m.xb, 2)) ELSE 0e0 END AS fit
            FROM m{t} m JOIN win ON win.i = m.i AND win.network = m.network AND win.station = m.station
              JOIN p{t} p ON p.slot = j AND p.network = m.network AND p.station = m.station GROUP BY ALL"""))
        steps.append((f"e{t}", f"""SELECT p.network, p.station, p.slot, value, CASE WHEN sw > 0 THEN f.fit ELSE value END AS fit,
            abs(value - CASE WHEN sw > 0 THEN f.fit ELSE value END) AS e FROM p{t} p JOIN f{t} f USING (network, station, slot)"""))
        steps.append((f"p{t + 1}", f"""SELECT network, station, slot, value, fit,
            CASE WHEN s > 0 THEN CASE WHEN e / s >= 1 - 1e-9 THEN 0e0 ELSE power(1 - power(e / s, 2), 2) END
                 WHEN e > 0 THEN 0e0 ELSE 1e0 END AS rw
            FROM (SELECT *, 6 * median(e) OVER (PARTITION BY network, station) AS s
              FROM (SELECT * REPLACE (CASE WHEN e <= 1e-10 * max(abs(value)) OVER (PARTITION BY network, station)
                THEN 0e0 ELSE e END AS e) FROM e{t}) z) q"""))
    steps.append((name, "SELECT network, station, slot, value, fit AS smooth FROM p4"))
    return steps


def minmax_params(columns, source: str = "clean", where: str = "") -> tuple[str, str]:
    parts = " UNION ALL ".join(
        f"SELECT network, station, '{c}' AS \"column\", min({c}) AS center, "
        f"CASE WHEN min({c}) = max({c}) THEN 1e0 ELSE max({c}) - min({c}) END AS scale FROM {source} {where} GROUP BY 1, 2"
        for c in columns)
    return "params", parts


def standard_params(columns, source: str = "clean") -> tuple[str, str]:
    parts = " UNION ALL ".join(
        f"SELECT network, station, '{c}' AS \"column\", avg({c}) AS center, "
        f"CASE WHEN min({c}) = max({c}) THEN 1e0 ELSE stddev_pop({c}) END AS scale FROM {source} GROUP BY 1, 2"
        for c in columns)
    return "params", parts


def scaled_wide(columns, source: str = "clean") -> tuple[str, str]:
    cells = ", ".join(f"(c.{c} - max(CASE WHEN p.\"column\" = '{c}' THEN p.center END)) / "
                      f"max(CASE WHEN p.\"column\" = '{c}' THEN p.scale END) AS {c}" for c in columns)
    names = ", ".join(f"c.{c}" for c in columns)
    return "scaled", (f"SELECT c.network, c.station, c.valid, {cells} FROM {source} c JOIN params p USING (network, station) "
                      f"GROUP BY c.network, c.station, c.valid, {names}")


def rounded(columns, keys=("network", "station", "valid"), source: str = "clean") -> str:
    return f"SELECT {', '.join(keys)}, {', '.join(f'{r6(c)} AS {c}' for c in columns)} FROM {source}"


def dtw_steps(pairs: str, n: int, keys: str) -> list[tuple[str, str]]:
    """Squared DTW cost of (a, b) array pairs, one recursion step per row of the cost matrix.

    A row's cells are folded left to right; the list starts with the cell left of the row.
    """
    cell = "power(a[i + 1] - b[j], 2) + list_min([acc[len(acc)], line[j], line[j + 1]])"
    fold = (f"list_reduce(range(1, {n + 1}), lambda acc, j: list_append(acc, {cell}), ['inf'::DOUBLE])")
    return [
        ("pairs", pairs),
        ("steps", f"""SELECT {keys}, a, b, 0 AS i, list_concat([0e0], list_transform(range({n}), lambda x: 'inf'::DOUBLE)) AS line
            FROM pairs UNION ALL SELECT {keys}, a, b, i + 1, {fold} FROM steps WHERE i < {n}"""),
        ("costs", f"SELECT {keys}, line[{n + 1}] AS cost FROM steps WHERE i = {n}"),
    ]
