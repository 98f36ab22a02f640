"""Scans of the observation and dimension tables, with explicit schemas."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline import schema as S
from gustline import versions
from gustline.functions.timeline import from_year
from gustline.operators.select import main_columns as pick_main
from gustline.operators.select import members, min_spread, overlapping


def without_nan(df: DataFrame) -> DataFrame:
    """Not-a-number counts as missing: it becomes null on the way in, so one kind of missing is left."""
    doubles = [c for c, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in doubles}) if doubles else df


def _csv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    return without_nan(spark.read.schema(schema).option("header", True).csv(path))


def read_stored(spark: SparkSession, path: str, networks=None, stations=None) -> DataFrame | None:
    """The newest version of a table of stations, of the buckets that the stations asked for are in by the table's contents; None
    if there is no such table. Rows of other stations in these buckets are left to the caller's filter."""
    version = versions.current(spark, path)
    if not version.number:
        return None
    schema = T.StructType.fromJson(json.loads(version.info["schema"]))
    parts = None
    if (networks is not None or stations is not None) and version.of(["contents"]):
        contents = spark.read.parquet(*[f"{path}/{f}" for f in version.of(["contents"])])
        # At most a row per bucket.
        parts = {str(r[0]) for r in _of_stations(contents, networks, stations).select("__bucket").distinct().collect()}
    found = [f for p, names in version.folders.items() if p != "contents" and (parts is None or p in parts) for f in names]
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in sorted(found)]) if found else spark.createDataFrame([], schema)


def _of_stations(df: DataFrame, networks, stations) -> DataFrame:
    df = members(df, "network", networks, "network")
    if isinstance(stations, DataFrame):
        shared = [F.col("sid").alias("station")] + (["network"] if "network" in stations.columns else [])
        wanted = stations.select(*shared)
        return df.join(wanted, wanted.columns, "left_semi")
    return members(df, "station", stations)


def scan_observations(spark: SparkSession, path, category: str = "fetched", since=None, until=None,
                      networks=None, stations=None, main: bool = False, columns: Sequence[str] | None = None,
                      kind: str = "parquet") -> DataFrame:
    """Observations of the stations and time range asked for.

    ``category`` fixes the types of CSV files: fetched reports, or preprocessed doubles (``columns`` names
    them). In a stored table, network and station choose buckets; stations, the time range and the columns
    reach the file scan. ``until`` is included.
    """
    if kind == "parquet":
        stored = read_stored(spark, path, networks, stations)
        df = without_nan(spark.read.parquet(path) if stored is None else stored)
    elif category == "fetched":
        df = _csv(spark, path, S.OBSERVATIONS)
    elif category in ("preprocessed", "modeled"):
        df = _csv(spark, path, S.preprocessed_schema(columns or S.MAIN_COLUMNS))
    else:
        raise ValueError(f"unknown category {category!r}")
    return observations(df, since, until, networks, stations, main, columns)


def observations(df: DataFrame, since=None, until=None, networks=None, stations=None, main: bool = False,
                 columns: Sequence[str] | None = None, time: str = "valid") -> DataFrame:
    """The same selection on any observation frame. ``stations``: an ID, a list, or a station frame."""
    if since is not None:
        df = df.where(F.col(time) >= F.lit(str(since)).cast("timestamp_ntz"))
    if until is not None:
        df = df.where(F.col(time) <= F.lit(str(until)).cast("timestamp_ntz"))
    df = _of_stations(df, networks, stations)
    if columns is not None:
        df = df.select(*[c for c in (*S.KEYS, "valid", *columns) if c in df.columns])
    return pick_main(df) if main else df


def read_networks(spark: SparkSession, path, networks=None, main: bool = False) -> DataFrame:
    return network_info(_csv(spark, path, S.NETWORKS), networks, main)


def network_info(df: DataFrame, networks=None, main: bool = False) -> DataFrame:
    df = members(df, "network", networks)
    return pick_main(df, S.SHORT_NETWORK, ()) if main else df


def read_stations(spark: SparkSession, path, **options) -> DataFrame:
    df = _csv(spark, path, S.STATION_FILE)
    dated = df.withColumns({c: from_year(F.col(c)) for c in ("start", "end")})
    return station_info(dated, **options)


def station_info(df: DataFrame, networks=None, stations=None, main: bool = False, since=None, until=None,
                 as_of=None) -> DataFrame:
    """Stations in service at some time of the range; a missing end means still in service at ``as_of``."""
    df = members(members(df, "network", networks), "sid", stations)
    df = overlapping(df, since, until, open_end=True, as_of=as_of)
    return pick_main(df, S.SHORT_STATION, ()) if main else df


def read_fires(spark: SparkSession, path, **options) -> DataFrame:
    return fire_info(_csv(spark, path, S.FIRES), **options)


def fire_info(df: DataFrame, networks=None, main: bool = False, since=None, until=None, least_spread: float = 0) -> DataFrame:
    df = members(df, "network", networks)
    if main:
        df = pick_main(df, S.SHORT_FIRE, ())
    return min_spread(overlapping(df, since, until), least_spread)


def with_network(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Add the network of each row's station from the station table."""
    lookup = stations.select(F.col("sid").alias("station"), "network")
    return df.join(lookup, "station")
