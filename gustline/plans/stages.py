"""The stored stages: ingest, clean, scale, split, cluster. Each reads a table, writes one, and covers all
stations in one plan. Tables live under one root, by category and subcategory, in buckets of stations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.operators.cluster import align_labels, assign_dtw, stored_dtw_model
from gustline.operators.dedup import dedup_best
from gustline.operators.scale import SCALERS, apply_scaler, stored_scaler
from gustline.operators.select import drop_empty_columns, listed
from gustline.operators.smooth import smooth_rows
from gustline.operators.split import split_series
from gustline.plans.clean import clean
from gustline.schema import KEYS, MAIN_COLUMNS
from gustline.sources.documents import network_options
from gustline.sources.payloads import parse_payloads
from gustline.sources.sinks import write_networks, write_observations, write_split
from gustline.sources.tables import observations, read_stored, scan_observations

# Fixed value: share of a day that one smoothing window covers.
DAY_FRAC = 0.4


@dataclass(frozen=True)
class Layout:
    """Paths of the stored tables."""

    root: str

    def table(self, category: str, subcategory: str = "") -> str:
        return "/".join(p for p in (self.root.rstrip("/"), category, subcategory) if p)

    fetched = property(lambda self: self.table("fetched"))
    clean = property(lambda self: self.table("preprocessed", "clean"))
    clusters = property(lambda self: self.table("modeled", "kmeans_timeseries"))
    scalers = property(lambda self: self.table("models", "scalers"))
    models = property(lambda self: self.table("models", "kmeans_timeseries"))

    def scaled(self, scaler: str) -> str:
        return self.table("preprocessed", f"scaled_{scaler}")

    def split(self, subcategory: str) -> str:
        return self.table("split", subcategory)


# --- transformations ---------------------------------------------------------------------------------

def ingest(payloads: DataFrame, duplicates: bool = False, keep: Sequence[str] = ("network",), payload: str = "payload",
           order: Sequence[str] = ()) -> DataFrame:
    """Payload texts to reports, one per station and time unless duplicates are wanted.

    ``order`` names payload columns that precede the line number in the source order; payloads of one
    station are otherwise taken to be one text.
    """
    rows = parse_payloads(payloads, payload, keep=[*keep, *order], line_number="__line")
    place = F.struct(*order, "__line") if order else F.col("__line")
    rows = rows.withColumn("src_seq", place)
    if not duplicates:
        measured = [c for c in rows.columns if c not in {*order, "__line", "src_seq"}]
        rows = dedup_best(rows, counted=measured)
    return rows.drop("src_seq", "__line", *order)


def split_days(df: DataFrame, columns: Sequence[str] | None = None, start: str | None = None,
               smooth: bool = True, frac: float = DAY_FRAC) -> DataFrame:
    """Daily rows of 24 hourly values for every measurement, smoothed."""
    rows = split_series(df, columns, start=start)
    return smooth_rows(rows, frac=frac) if smooth else rows


def scalers_wanted(scaler) -> list[str]:
    names = listed(scaler.split() if isinstance(scaler, str) else scaler) or []
    return [n for n in names if n in SCALERS]


# --- stored stages -----------------------------------------------------------------------------------

def run_ingest(payloads: DataFrame, layout: Layout, **options) -> None:
    write_observations(ingest(payloads, **options), layout.fetched)


def run_network_ingest(pages: DataFrame, html: str, path: str) -> None:
    write_networks(network_options(pages, html), path)


def run_clean(spark: SparkSession, layout: Layout, stations=None, since=None, until=None, main: bool = True) -> DataFrame:
    """Clean the fetched table."""
    reports = scan_observations(spark, layout.fetched, since=since, until=until, stations=stations)
    write_observations(clean(reports, main=main), layout.clean)
    return _clean_table(spark, layout, stations, since, until, main)


def _clean_table(spark, layout: Layout, stations, since, until, main: bool) -> DataFrame:
    """The cleaned rows; a measurement without any value is dropped, decided on the small hourly table."""
    table = scan_observations(spark, layout.clean, "preprocessed", _hour(since), until, stations=stations, main=main)
    return drop_empty_columns(table)


def _hour(since):
    """The first bucket starts with the hour of the first report."""
    if since is None:
        return None
    return datetime.fromisoformat(str(since)).replace(minute=0, second=0, microsecond=0)


def run_scale(spark: SparkSession, layout: Layout, stations=None, since=None, until=None, main: bool = True,
              scaler=None, refit: bool = False) -> dict[str, DataFrame]:
    table = _clean_table(spark, layout, stations, since, until, main)
    columns = [c for c in table.columns if c not in (*KEYS, "valid")]
    written = {}
    for name in scalers_wanted(scaler or "minmax"):
        params = stored_scaler(table, layout.scalers, name, "main" if main else "", refit, columns=columns)
        write_observations(apply_scaler(table, params), layout.scaled(name))
        written[name] = read_stored(spark, layout.scaled(name))
    return written


def run_split(spark: SparkSession, layout: Layout, stations=None, since=None, until=None, main: bool = True,
              split: str = "clean", scaler=None) -> dict[str, DataFrame]:
    """Split the clean table, the scaled ones, or both ("clean", "scaled", "all")."""
    sources = {"clean": layout.clean} if split in ("clean", "all") else {}
    if split in ("scaled", "all"):
        sources |= {f"scaled_{n}": layout.scaled(n) for n in scalers_wanted(scaler)}
    for name, path in sources.items():
        table = scan_observations(spark, path, "preprocessed", _hour(since), until, stations=stations, main=main)
        write_split(split_days(drop_empty_columns(table)), layout.split(name))
    return {name: read_stored(spark, layout.split(name)) for name in sources}


def run_preprocess(spark: SparkSession, layout: Layout, stations=None, since=None, until=None, main: bool = True,
                   split: str = "", scaler=None, refit: bool = False) -> None:
    """Clean once, then scale and split from the written clean table."""
    run_clean(spark, layout, stations, since, until, main)
    if scaler is not None:
        run_scale(spark, layout, stations, since, until, main, scaler, refit)
    if split:
        run_split(spark, layout, stations, since, until, main, split, scaler)


def stored_days(spark: SparkSession, layout: Layout, stations=None, since=None, until=None) -> DataFrame:
    """Split clean rows of the stations whose day starts in the range."""
    return observations(read_stored(spark, layout.split("clean"), stations=stations), _hour(since), until, stations=stations, time="day")


def run_cluster(spark: SparkSession, layout: Layout, stations=None, since=None, until=None, clusters: int = 5,
                refit: bool = False, **options) -> DataFrame:
    """Cluster the days of the seven main measurements; one row per station and day, a label per column."""
    split = stored_days(spark, layout, stations, since, until)
    split = split.where(F.col("column").isin(*MAIN_COLUMNS))
    model = stored_dtw_model(split, layout.models, clusters, refit, **options)
    labels = align_labels(assign_dtw(split, model), MAIN_COLUMNS)
    write_observations(labels, layout.clusters)
    return read_stored(spark, layout.clusters)
