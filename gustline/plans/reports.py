"""Report tables per dataset: distribution, time course, clusters, smoothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline import versions
from gustline.functions.describe import descriptions
from gustline.operators import profile as P
from gustline.operators.cluster import with_labels
from gustline.operators.smooth import smooth_rows
from gustline.operators.split import unsplit
from gustline.plans.stages import Layout, stored_days
from gustline.schema import KEYS
from gustline.sources.tables import observations, read_stored, scan_observations
from gustline.storage import materialize


def measured_columns(df: DataFrame, skip: Sequence[str] = (*KEYS, "valid", "src_seq")) -> list[str]:
    return [c for c in df.columns if c not in skip]


def distribution_tables(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Missing counts for all columns; histogram, density and box statistics for numeric ones; category
    counts for the others with few values."""
    columns = list(columns) if columns is not None else measured_columns(df)
    numeric = [c for c in columns if P.is_numeric(df, c)]
    others = [c for c in columns if c not in numeric]
    tables, missing = {}, []
    if numeric:
        # Four scans at most: cells, the cells with a quartile, what depends on the quartiles, and the other columns.
        cells = P.value_cells(df, numeric, keys)
        missing.append(cells.groupBy(*keys, "column").agg(
            F.sum(F.when(F.col("__cell").isNotNull(), F.col("n")).otherwise(0)).alias("present"),
            F.sum(F.when(F.col("__cell").isNull(), F.col("n")).otherwise(0)).alias("missing")))
        summary = P.summaries(df, numeric, keys, cells)
        given = P.spread(df, numeric, keys, summary)
        tables |= {name: table(df, numeric, keys, summary=summary, given=given) for name, table in (
            ("histogram", P.histogram), ("density", P.density), ("box", P.box_stats))}
        tables["outliers"] = P.outliers(df, numeric, keys, summary=summary)
    if others and keys:
        missing.append(P.missing_counts(df, others, keys))
        few = {r["column"] for r in P.column_gates(df, others).where("has_few_values").collect()}
        if few:
            tables["categories"] = P.category_counts(df, [c for c in others if c in few], keys)
    elif others:
        met = materialize(P.values_met(df, others, P.MAX_CATEGORIES), "values")
        counts = met.where("kind <> 'value'").groupBy("column")
        missing.append(counts.agg(*[F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in ("present", "missing")]))
        tables["categories"] = P.few_values(met)
    for part in missing:
        tables["missing"] = tables["missing"].unionByName(part) if "missing" in tables else part
    return tables


def distribution_profile(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """The same as one long table: ``(keys, column, part, item, value)``."""
    return profile_rows(distribution_tables(df, columns, keys), keys)


def profile_rows(tables: dict[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """The distribution tables among ``tables`` as one."""
    def part(table: DataFrame, name: str, item: Column, value: Column) -> DataFrame:
        return table.select(*keys, "column", F.lit(name).alias("part"), item.cast("string").alias("item"),
                            value.cast("double").alias("value"))

    def fields(table: DataFrame, name: str, names: Sequence[str]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(n).alias("item"), F.col(n).cast("double").alias("value")) for n in names])
        return table.select(*keys, "column", F.explode(cells).alias("c")).select(
            *keys, "column", F.lit(name).alias("part"), "c.item", "c.value")

    parts = [fields(tables["missing"], "missing", ("present", "missing"))]
    if "histogram" in tables:
        parts.append(part(tables["histogram"], "histogram", F.col("bin"), F.col("n")))
        parts.append(part(tables["density"], "density", F.col("point"), F.col("density")))
        parts.append(fields(tables["box"], "box", (
            "n", "q1", "median", "q3", "mean", "whisker_low", "whisker_high", "outliers")))
    if "categories" in tables:
        parts.append(part(tables["categories"], "category", F.col("value"), F.col("n")))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def time_tables(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = (),
                time: str = "valid") -> dict[str, DataFrame]:
    """Monthly course for numeric columns, and seasonal tables where the months are complete."""
    columns = [c for c in (columns or measured_columns(df)) if P.is_numeric(df, c)]
    if not columns or dict(df.dtypes).get(time) not in ("timestamp_ntz", "timestamp"):
        return {}
    return {"monthly": P.monthly(df, columns, keys, time), "quarterly": P.quarterly(df, columns, keys, time),
            "seasonal_months": P.seasonal_months(df, columns, keys, time),
            "seasonal_quarters": P.seasonal_quarters(df, columns, keys, time)}


def time_profile(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = (), time: str = "valid") -> DataFrame:
    """The time tables as one: ``(keys, column, part, season, year, value, season_mean, angle)``."""
    t = time_tables(df, columns, keys, time)
    none = F.lit(None).cast("double")

    def part(table: DataFrame, name: str, season: Column, mean: Column, angle: Column) -> DataFrame:
        return table.select(*keys, "column", F.lit(name).alias("part"), season.cast("string").alias("season"), "year",
                            "value", mean.alias("season_mean"), angle.alias("angle"))

    return (
        part(t["monthly"], "monthly", F.col("month"), none, F.col("angle"))
        .unionByName(part(t["quarterly"], "quarterly", F.col("quarter"), none, none))
        .unionByName(part(t["seasonal_months"], "seasonal_months", F.col("month"), F.col("season_mean"), none))
        .unionByName(part(t["seasonal_quarters"], "seasonal_quarters", F.col("quarter"), F.col("season_mean"), none)))


def cluster_tables(split: DataFrame, labels: DataFrame, model: DataFrame) -> dict[str, DataFrame]:
    """Centers, member rows per cluster, and the stacked series with the label of its day."""
    members = with_labels(split, labels)
    return {"centers": model.select(*KEYS, "column", "cluster", F.posexplode("center").alias("slot", "value")),
            "members": members, "stacked": unsplit(members)}


def smoothing_table(split: DataFrame, **options) -> DataFrame:
    """Value before and after smoothing for every slot."""
    both = smooth_rows(split, into="smooth", **options)
    kept = [c for c in both.columns if c not in ("values", "smooth")]
    return both.select(*kept, F.posexplode(F.arrays_zip("values", "smooth")).alias("slot", "v")).select(
        *kept, "slot", F.col("v.values").alias("value"), F.col("v.smooth").alias("smooth"))


def station_reports(spark: SparkSession, layout: Layout, category: str = "fetched", subcategory: str = "",
                    stations=None, since=None, until=None, main: bool = False) -> dict[str, DataFrame]:
    """All report tables of a stored dataset, per station."""
    if category == "modeled":
        split = stored_days(spark, layout, stations, since, until)
        wide = observations(read_stored(spark, layout.clusters, stations=stations), stations=stations)
        found = [c for c in wide.columns if c not in (*KEYS, "day")]
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("cluster")) for c in found])
        labels = wide.select(*KEYS, "day", F.explode(cells).alias("c")).select(*KEYS, "day", "c.*").where("cluster is not null")
        return cluster_tables(split, labels, versions.read(spark, layout.models))
    if category not in ("fetched", "preprocessed"):
        raise ValueError(f"unknown category {category!r}")
    subcategory = "" if category == "fetched" else subcategory or "clean"
    table = scan_observations(spark, layout.table(category, subcategory), category, since, until, stations=stations, main=main)
    known = descriptions(category == "preprocessed", subcategory in ("", "clean"))
    columns = [c for c in measured_columns(table) if c in known]
    return {**distribution_tables(table, columns, KEYS), **time_tables(table, columns, KEYS)}
