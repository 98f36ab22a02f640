"""Observation, station and fire tables derived from the given tables, once for Spark and once as SQL.

One text serves both: ``{ts}`` is the naive timestamp type, ``{q}`` the identifier quote and the names in
braces the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_OBSERVATIONS = """
SELECT CASE WHEN event_type IN ('click','view') THEN 'NET_A' ELSE 'NET_B' END AS network,
  {station} AS station, {valid} AS valid, event_id AS src_seq,
  CASE WHEN k % 10 <> 0 THEN value END AS tmpf, CASE WHEN k % 7 <> 3 THEN value / 2e0 END AS dwpf,
  CASE WHEN k % 6 <> 5 THEN k * 1e0 END AS relh, CASE WHEN k % 8 <> 1 THEN k * 3e0 END AS drct,
  CASE WHEN k % 9 <> 4 THEN k / 4e0 END AS sknt,
  CASE WHEN k % 4 = 0 THEN value / 1e2 WHEN k % 4 = 1 THEN 0e0 END AS p01i,
  CASE WHEN k % 5 <> 2 THEN k / 1e1 END AS vsby, CASE WHEN k % 3 = 0 THEN value END AS gust,
  CASE k % 8 WHEN 0 THEN 'CLR' WHEN 1 THEN 'FEW' WHEN 2 THEN 'SCT' WHEN 3 THEN 'BKN'
             WHEN 4 THEN 'OVC' WHEN 5 THEN 'VV ' WHEN 6 THEN '???' END AS skyc1,
  CASE WHEN k % 5 <> 0 THEN k * 1e2 END AS skyl1, CASE WHEN k % 10 <> 0 THEN value + 1e0 END AS feel
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM {events}) e
"""

_STATIONS = """
SELECT s_name AS sid, concat('NET_', CAST(s_nationkey AS STRING)) AS network, s_suppkey AS seq,
  CAST(make_date(1993 + CAST(s_suppkey % 10 AS INT), 1, 1) AS {ts}) AS {q}start{q},
  CASE WHEN s_suppkey % 4 = 0 THEN CAST(make_date(1996 + CAST(s_suppkey % 10 AS INT), 1, 1) AS {ts}) END AS {q}end{q},
  30e0 + (s_suppkey * 37 % 1000) / 1e2 AS lat, 20e0 + (s_suppkey * 53 % 1500) / 1e2 AS lon
FROM {supplier}
"""

_FIRES = """
SELECT o_orderkey AS fire_id, concat('NET_', CAST(o_custkey % 25 AS STRING)) AS network, o_orderdate AS {q}start{q},
  CASE WHEN o_orderkey % 9 <> 0 THEN greatest(last_ship, o_orderdate) END AS {q}end{q},
  CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice / 1e3 END AS spread,
  30e0 + (o_custkey * 91 % 1000) / 1e2 AS lat, 20e0 + (o_custkey * 17 % 1500) / 1e2 AS lon
FROM {orders} JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM {lineitem} GROUP BY l_orderkey) m
  ON o_orderkey = l_orderkey
"""

_TABLES = ("events", "supplier", "orders", "lineitem")
_STATION_BY = {"type": "event_type", "user": "CAST(user_id AS STRING)"}
_TIME = {"exact": "ts", "hour": "CAST(date_trunc('hour', ts) AS {ts})"}
_SPARK = {"ts": "TIMESTAMP_NTZ", "q": "`"}
_DUCK = {"ts": "TIMESTAMP", "q": '"', **{t: t for t in _TABLES}}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _frame(spark: SparkSession, folder: str, text: str, *names: str, **extra: str) -> DataFrame:
    marks = {**_SPARK, **extra}
    for mark, value in marks.items():
        text = text.replace("{" + mark + "}", value.replace("{ts}", _SPARK["ts"]))
    return spark.sql(text, **{n: table(spark, folder, n) for n in names})


def _sql(text: str, **extra: str) -> str:
    for mark, value in {**extra, **_DUCK}.items():
        text = text.replace("{" + mark + "}", value)
    return text


def obs(spark: SparkSession, folder: str, station: str = "type", time: str = "exact") -> DataFrame:
    return _frame(spark, folder, _OBSERVATIONS, "events", station=_STATION_BY[station], valid=_TIME[time])


def stations(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(spark, folder, _STATIONS, "supplier")


def fires(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(spark, folder, _FIRES, "orders", "lineitem")


def obs_sql(station: str = "type", time: str = "exact") -> str:
    return _sql(_OBSERVATIONS, station=_STATION_BY[station], valid=_TIME[time])


STATIONS_SQL = _sql(_STATIONS)
FIRES_SQL = _sql(_FIRES)
