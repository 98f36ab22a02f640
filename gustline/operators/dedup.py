"""One report per station and time: the most complete one, the last in source order on a tie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.schema import KEYS


def present_cells(columns: Sequence[str]) -> Column:
    """Number of non-null cells among the columns."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNotNull().cast("int")
    return total


def dedup_best(df: DataFrame, keys: Sequence[str] = KEYS, time: str = "valid", source_order: str = "src_seq",
               counted: Sequence[str] | None = None) -> DataFrame:
    """Keep the best row per ``(keys, time)``.

    Spark puts a first-row limit before the exchange (``WindowGroupLimit``), so each task sends at most
    one row of a time on, however often that time is repeated.
    """
    if counted is None:
        counted = [c for c in df.columns if c != source_order]
    best = Window.partitionBy(*keys, time).orderBy(F.col("__present").desc(), F.col(source_order).desc())
    return (
        df.withColumn("__present", present_cells(counted))
        .withColumn("__rank", F.row_number().over(best))
        .where(F.col("__rank") == 1)
        .drop("__present", "__rank")
    )
