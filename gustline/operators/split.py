"""Series to rows of fixed width and back; per-row scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.timeline import epoch_micros, step_seconds
from gustline.operators.running import with_row_numbers
from gustline.schema import KEYS
from gustline.storage import materialize

DAY_SLOTS = 24


def _measurements(df: DataFrame, keys: Sequence[str], time: str, start: str | None) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in (time, start)]


def _padded(values: Column, width: int) -> Column:
    """The last chunk is filled up with its last value."""
    missing = F.lit(width) - F.size(values)
    return F.when(missing > 0, F.concat(values, F.array_repeat(F.element_at(values, -1), missing))).otherwise(values)


def split_series(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = KEYS,
                 time: str = "valid", width: int = DAY_SLOTS, frequency: str | int = "1 hour",
                 start: str | None = None) -> DataFrame:
    """A regular series to long rows ``(keys, column, day, values)`` of ``width`` values each.

    Rows are positional: they are counted from the station's first time, so a day starts at midnight only
    if the series does. ``day`` is the time of the row's first value. ``start`` names a column with the
    station's first time; without it the first times are aggregated and joined.
    """
    step = step_seconds(frequency)
    columns = list(columns) if columns is not None else _measurements(df, keys, time, start)
    columns = [c for c in columns if c in df.columns]
    rows = df
    if start is None:
        start = "__start"
        # One row per station, written: the join is planned by its size.
        rows = df.join(materialize(df.groupBy(*keys).agg(F.min(time).alias(start)), "starts"), list(keys))
    place = F.floor((epoch_micros(F.col(time)) - epoch_micros(F.col(start))) / F.lit(step * 1_000_000))
    placed = rows.select(
        *keys, *columns,
        F.floor(place / width).alias("__row"), F.pmod(place, F.lit(width)).alias("__slot"),
        F.col(time).alias("__time"))
    # All columns travel together; a group holds at most ``width`` rows.
    chunks = placed.groupBy(*keys, "__row").agg(
        F.min("__time").alias("day"),
        F.sort_array(F.collect_list(F.struct("__slot", *columns))).alias("__cells"))
    return _long_rows(chunks, columns, [*keys, "day"], width)


def split_rows(df: DataFrame, columns: Sequence[str], width: int, keys: Sequence[str] = KEYS,
               order: Sequence[str] = ("valid",)) -> DataFrame:
    """Like :func:`split_series` for any order: rows are counted, not timed; the index is ``row``."""
    numbered = with_row_numbers(df, order, keys, "__place")
    chunks = numbered.groupBy(*keys, F.floor(F.col("__place") / width).alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("__place", *columns))).alias("__cells"))
    return _long_rows(chunks, columns, [*keys, "row"], width)


def _long_rows(chunks: DataFrame, columns: Sequence[str], index: Sequence[str], width: int) -> DataFrame:
    def series(c: str) -> Column:
        values = F.transform(F.col("__cells"), lambda cell: cell[c])
        return F.struct(F.lit(c).alias("column"), _padded(values, width).alias("values"))

    return chunks.select(*index, F.explode(F.array(*[series(c) for c in columns])).alias("__s")).select(
        *index[:-1], "__s.column", index[-1], "__s.values")


def unsplit(df: DataFrame, frequency: str | int = "1 hour", time: str = "valid", values: str = "values") -> DataFrame:
    """One row per value again, at day plus slot."""
    step = step_seconds(frequency)
    kept = [c for c in df.columns if c != values]
    zero = F.lit(0)
    flat = df.select(*kept, F.posexplode(values).alias("slot", "value"))
    shift = F.make_dt_interval(zero, zero, zero, (F.col("slot") * step).cast("decimal(18,6)"))
    return flat.withColumn(time, F.col("day") + shift)


def scale_rows(df: DataFrame, scaler: str = "minmax", values: str = "values",
               feature_range: tuple[float, float] = (0.0, 1.0), clip: bool = False,
               with_mean: bool = True, with_std: bool = True) -> DataFrame:
    """Scale every row by its own values."""
    v = F.col(values)
    present = F.filter(v, lambda x: x.isNotNull())
    n = F.size(present)
    if scaler == "minmax":
        low, high = (float(x) for x in feature_range)
        least, spread = F.array_min(present), F.array_max(present) - F.array_min(present)
        unit = F.when(spread == 0, F.lit(1.0)).otherwise(spread)

        def cell(x: Column) -> Column:
            y = (x - F.col("__center")) / F.col("__unit") * (high - low) + low
            return F.when(x.isNotNull(), F.least(F.greatest(y, F.lit(low)), F.lit(high))) if clip else y
        center = least
    elif scaler == "standard":
        total = F.aggregate(present, F.lit(0.0), lambda s, x: s + x)
        mean = F.when(n > 0, total / n)
        squares = F.aggregate(present, F.lit(0.0), lambda s, x: s + (x - F.col("__mean")) * (x - F.col("__mean")))
        constant = F.array_min(present) == F.array_max(present)
        unit = F.when(constant, F.lit(1.0)).otherwise(F.sqrt(squares / n)) if with_std else F.lit(1.0)
        center = F.col("__mean") if with_mean else F.lit(0.0)
        df = df.withColumn("__mean", mean)

        def cell(x: Column) -> Column:
            return (x - F.col("__center")) / F.col("__unit")
    else:
        raise ValueError(f"unknown scaler {scaler!r}")
    helped = df.withColumn("__center", center).withColumn("__unit", unit)
    return helped.withColumn(values, F.transform(v, cell)).drop("__center", "__unit", "__mean")
