"""Table sinks: observation tables by buckets of stations, dimension files."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline import versions
from gustline.functions.timeline import to_year
from gustline.operators.select import main_columns
from gustline.schema import KEYS
from gustline.sources.tables import fire_info, network_info, station_info


# Buckets that a new table's stations are dealt to; a table keeps the number it began with.
BUCKETS = 64
_BUCKET = "__bucket"


def write_observations(df: DataFrame, path: str, main: bool = False, by: Sequence[str] = KEYS,
                       mode: str = "overwrite", buckets: int = BUCKETS) -> None:
    """Stations in hash buckets, with a table of contents (station, bucket) that scans prune by; rows lie by station within a file.
    Of the stations (or whatever groups ``by`` names) in the frame the stored rows are replaced, others stay; ``mode`` "append"
    keeps them all.

    The number of folders is that of the buckets, however many stations there are. The rebalance step brings a bucket's rows
    together for few files, but cuts one that is too large for one task into several. The write is a version of the table
    (:mod:`gustline.versions`): readers see all of it or nothing.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    df = main_columns(df) if main else df

    def placed(rows: DataFrame, many: int) -> tuple[str, dict[str, list[str]]]:
        folder = versions.new_folder()
        spread = rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*KEYS), F.lit(many))).hint("rebalance", _BUCKET)
        spread.sortWithinPartitions(_BUCKET, *by).write.partitionBy(_BUCKET).parquet(f"{path}/{folder}")
        written = spark.read.schema(f"{_BUCKET} int").parquet(f"{path}/{folder}").select(_BUCKET).distinct().collect()
        return folder, {str(r[0]): f"{folder}/{_BUCKET}={r[0]}" for r in written}

    def make(base: versions.Version) -> versions.Version:
        many = base.info.get("buckets", buckets)
        schema = merged_schema(base.info.get("schema"), df.schema)
        folder, new = placed(df, many)
        folders = dict(base.folders)
        groups = spark.read.schema(df.schema).parquet(*[f"{path}/{f}" for f in new.values()]).select(*by).distinct() if new else None
        held = {b: folders[b] for b in new if b in folders}
        if held and mode == "overwrite":
            old = spark.read.schema(schema).parquet(*[f"{path}/{f}" for found in held.values() for f in found])
            kept = placed(old.join(groups, list(by), "left_anti"), many)[1]
            held = {b: [kept[b]] for b in held if b in kept}
        for b, f in new.items():
            folders[b] = [*held.get(b, []), f]
        if groups is not None:
            listed = versions.new_folder()
            stations = groups.select(*KEYS).distinct().withColumn(_BUCKET, F.pmod(F.xxhash64(*KEYS), F.lit(many)).cast("int"))
            stations.write.parquet(f"{path}/{listed}")
            folders["contents"] = [*folders.get("contents", []), listed]
        return replace(base, folders=folders, info={"buckets": many, "schema": schema.json()})

    versions.change(spark, path, make)


def merged_schema(known: str | None, fresh: T.StructType) -> T.StructType:
    """Fields of the stored table and then the new ones; a field keeps its type."""
    old = T.StructType.fromJson(json.loads(known)).fields if known else []
    kinds = {f.name: f.dataType for f in old}
    for f in fresh:
        if kinds.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is stored as {kinds[f.name].simpleString()}, not {f.dataType.simpleString()}")
    more = [T.StructField(f.name, f.dataType) for f in fresh if f.name not in kinds]
    return T.StructType([*old, *more])


def write_split(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Split series; a measurement of a station is replaced by itself."""
    write_observations(df, path, by=(*KEYS, "column"), mode=mode)


def _write_csv(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_networks(df: DataFrame, path: str, networks=None, main: bool = False, mode: str = "overwrite") -> None:
    _write_csv(network_info(df, networks, main), path, mode)


def write_stations(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """Stations with their dates of service as years."""
    chosen = station_info(df, **options)
    years = {c: to_year(F.col(c)) for c in ("start", "end") if c in chosen.columns}
    _write_csv(chosen.withColumns(years) if years else chosen, path, mode)


def write_fires(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    _write_csv(fire_info(df, **options), path, mode)
