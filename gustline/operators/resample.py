"""Irregular reports to a regular series: bucket aggregates by column rule, and the dense bucket grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.frequency import Frequency, frequency_of
from gustline.functions.timeline import bucket_number, bucket_start
from gustline.operators.neighbours import NEXT_POSITION, placed, with_neighbours
from gustline.operators.quantiles import (
    SMALL_GROUP, exact_quantiles, median_of_counts, median_of_pair, middle_pair,
)
from gustline.schema import KEYS, RULES, SKY_CODES
from gustline.storage import materialize

BUCKET = "__bucket"
# Buckets of one station handled together when gaps are found; also the longest generated array.
CHUNK_BUCKETS = 4096


def known_rules(df: DataFrame, keys: Sequence[str] = KEYS, time: str = "valid") -> dict[str, str]:
    """Rule of every measurement the frame has; columns without a rule stay out."""
    return {c: RULES[c] for c in df.columns if c in RULES and c not in keys and c != time}


def _bucketed(df: DataFrame, frequency: Frequency, keys: Sequence[str], time: str) -> DataFrame:
    """Rows with their bucket: its start where that is cheap, its number otherwise."""
    rows = placed(df, keys, time)
    if frequency.anchored:
        # A row per series, written: the join is planned by its size.
        origins = rows.groupBy(*keys).agg(frequency.origin(F.min(time)).alias(frequency.carried[0]))
        rows = rows.join(materialize(origins, "origins"), list(keys))
    elif frequency.fixed:
        return rows.withColumn(BUCKET, bucket_start(F.col(time), frequency.size))
    return rows.withColumn(BUCKET, frequency.bucket(F.col(time)))


def bucket_aggregate(df: DataFrame, rules: dict[str, str], frequency: str | int | Frequency, keys: Sequence[str] = KEYS,
                     time: str = "valid") -> DataFrame:
    """One row per key and non-empty, numbered bucket: mean, max or exact median of each column; nulls are skipped.
    Buckets that depend on the series' beginning carry it along (:class:`Frequency`).

    Medians of code columns come from one counter per code. Other medians use a bounded sketch, exact up to
    ``SMALL_GROUP`` values, which are counted beside it; the buckets are written, and those with more values are ranked
    by :func:`exact_quantiles`, which never holds a bucket in one place. Results are exact for any bucket.
    """
    frequency = frequency_of(frequency)
    rows = _bucketed(df, frequency, keys, time)
    keys = [*keys, *frequency.carried]
    medians = [c for c, rule in rules.items() if rule == "median"]
    aggregates = []
    for c, rule in rules.items():
        if rule == "mean":
            aggregates.append(F.avg(c).alias(c))
        elif rule == "max":
            aggregates.append(F.max(c).alias(c))
        elif rule == "median":
            aggregates += [middle_pair(F.col(c)).alias(f"__pair_{c}"), F.count(c).alias(f"__n_{c}")]
        elif rule == "code_median":
            aggregates += [F.expr(f"count(CASE WHEN `{c}` = {i} THEN 1 END) AS `__n{i}_{c}`") for i in range(len(SKY_CODES))]
        else:
            raise ValueError(f"unknown rule {rule!r} for column {c!r}")
    grouped = rows.groupBy(*keys, BUCKET).agg(*aggregates)

    busy = None
    if medians:
        grouped = materialize(grouped, "buckets")
        most = F.greatest(F.lit(0), *[F.col(f"__n_{c}") for c in medians])
        # Written: the join that finds the rows of these buckets is planned by their number.
        busy = materialize(grouped.where(most > SMALL_GROUP).select(*keys, BUCKET), "busy")
        busy = None if busy.isEmpty() else busy

    def reduced(c: str, rule: str) -> Column:
        if rule == "code_median":
            return median_of_counts([f"__n{i}_{c}" for i in range(len(SKY_CODES))]).alias(c)
        if rule == "median":
            small = median_of_pair(F.col(f"__pair_{c}"), F.col(f"__n_{c}"))
            return (F.coalesce(F.col(f"__large_{c}"), small) if busy is not None else small).alias(c)
        return F.col(c)

    if busy is not None:
        grouped = grouped.join(_large_medians(rows, medians, keys, busy), [*keys, BUCKET], "left")
    counted = frequency.fixed and not frequency.anchored
    number = bucket_number(F.col(BUCKET), frequency.size).alias(BUCKET) if counted else F.col(BUCKET)
    return grouped.select(*keys, number, *[reduced(c, r) for c, r in rules.items()])


def _large_medians(rows: DataFrame, medians: Sequence[str], keys: list[str], busy: DataFrame) -> DataFrame:
    group = [*keys, BUCKET, "__column"]
    values = (
        rows.select(*keys, BUCKET, *medians).join(busy, [*keys, BUCKET], "left_semi")
        .select(*keys, BUCKET, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in medians])).alias("s"))
        .select(*keys, BUCKET, F.col("s.column").alias("__column"), F.col("s.value").alias("__value"))
    )
    exact = exact_quantiles(values, group, "__value", [0.5])
    wide = exact.groupBy(*keys, BUCKET).pivot("__column", list(medians)).agg(F.first(F.col("quantiles")[0]))
    return wide.select(*keys, BUCKET, *[F.col(c).alias(f"__large_{c}") for c in medians])


def expand_gaps(df: DataFrame) -> DataFrame:
    """Repeat each bucket row for the empty buckets up to the next one; ``__grid`` is the new number.

    Two steps, blocks and then buckets, keep each generated array within ``CHUNK_BUCKETS``.
    """
    here, size = F.col(BUCKET), F.lit(CHUNK_BUCKETS)
    last = F.coalesce(F.col(NEXT_POSITION) - 1, here)
    blocks = df.withColumn("__last", last).withColumn(
        "__block", F.explode(F.sequence(F.floor(here / size), F.floor(F.col("__last") / size))))
    first = F.col("__block") * size
    return blocks.withColumn("__grid", F.explode(F.sequence(
        F.greatest(here, first), F.least(F.col("__last"), first + size - 1)))).drop("__last", "__block")


def resample(df: DataFrame, rules: dict[str, str] | None = None, frequency: str | int | Frequency = "1 hour",
             keys: Sequence[str] = KEYS, time: str = "valid", dense: bool = True) -> DataFrame:
    """Bucket aggregates per key; with ``dense`` every bucket from first to last is present."""
    frequency = frequency_of(frequency)
    rules = known_rules(df, keys, time) if rules is None else rules
    buckets = bucket_aggregate(df, rules, frequency, keys, time)
    if not dense:
        return buckets.select(*keys, frequency.label(F.col(BUCKET)).alias(time), *rules)
    grid = expand_gaps(with_neighbours(buckets, BUCKET, [], keys, CHUNK_BUCKETS))
    real = F.col("__grid") == F.col(BUCKET)
    return grid.select(
        *keys, frequency.label(F.col("__grid")).alias(time),
        *[F.when(real, F.col(c)).alias(c) for c in rules])
