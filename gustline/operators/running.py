"""Running totals and row numbers of ordered groups, however large a group is.

Rows are range-partitioned by keys and order, so a large group lies in many partitions, in order. Totals run
within a partition and are shifted by the group's total in the earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.storage import materialize

_RANGE = "__range"


def with_running_total(df: DataFrame, order: Sequence[str], keys: Sequence[str], weight: Column, name: str) -> DataFrame:
    """Sum of the weights up to and with the row; the order columns must tell the rows of a group apart."""
    keys = list(keys)
    # Written, as the partition's number becomes data: it must not change when a task is run again.
    spread = materialize(
        df.withColumn("__weight", weight).repartitionByRange(*keys, *order).withColumn(_RANGE, F.spark_partition_id()),
        "ranges")
    earlier = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.groupBy(*keys, _RANGE).agg(F.sum("__weight").alias("__sum")).select(
        *keys, _RANGE, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    local = Window.partitionBy(*keys, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = spread.withColumn("__local", F.sum("__weight").over(local))
    return totals.join(offsets.hint("shuffle_hash"), [*keys, _RANGE]).select(
        *df.columns, (F.col("__local") + F.col("__offset")).alias(name))


def with_row_numbers(df: DataFrame, order: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    """Zero-based place of each row in its group."""
    return with_running_total(df, order, keys, F.lit(1).cast("bigint"), name).withColumn(name, F.col(name) - 1)
