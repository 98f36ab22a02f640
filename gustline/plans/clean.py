"""Raw reports to a complete regular series per station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.encode import cyclical, ordinal_code, positive_indicator, whole_code
from gustline.functions.frequency import Frequency, frequency_of
from gustline.operators.fill import Place, forward_backward, linear, slope
from gustline.operators.neighbours import FIRST_POSITION, NEXT_POSITION, with_neighbours
from gustline.operators.resample import BUCKET, CHUNK_BUCKETS, bucket_aggregate, expand_gaps
from gustline.schema import (
    CHECKED_CODE_COLUMNS, DIRECTION_COLUMN, EXTRA_COLUMNS, INDICATOR_COLUMNS, KEYS, MAIN_COLUMNS, MEAN_COLUMNS,
    RULES, SKY_CODE_COLUMNS,
)
from gustline.sources.tables import without_nan

SERIES_START = "series_start"
_REPORTED = "__reported_"


def kept_measurements(columns: Sequence[str], main: bool) -> list[str]:
    """Measurements a clean keeps, in the order of the frame."""
    wanted = MAIN_COLUMNS if main else MAIN_COLUMNS + EXTRA_COLUMNS
    return [c for c in columns if c in wanted]


def encode_reports(df: DataFrame, columns: Sequence[str], keys: Sequence[str], time: str) -> DataFrame:
    df = without_nan(df)
    kinds = dict(df.dtypes)

    def encoded(c: str) -> Column:
        if c.startswith(_REPORTED):
            return F.when(F.col(c.removeprefix(_REPORTED)).isNotNull(), F.lit(1.0)).alias(c)
        if c in SKY_CODE_COLUMNS and kinds[c] == "string":
            return ordinal_code(F.col(c)).alias(c)
        if c in INDICATOR_COLUMNS:
            return positive_indicator(F.col(c)).alias(c)
        return F.col(c)

    return df.select(*keys, time, *[encoded(c) for c in [*columns, *_reported(columns)]])


def clean(df: DataFrame, main: bool = True, frequency: str | int | Frequency = "1 hour", keys: Sequence[str] = KEYS,
          time: str = "valid", with_start: bool = False) -> DataFrame:
    """Encode, resample, fill; one row per station and bucket, no gaps, all measurements double.

    Filling is decided on the non-empty buckets: each carries its neighbours' values, so the rows of a
    gap are computed where they are generated and the dense series never passes a sort or an exchange.
    ``with_start`` adds the first time of the station's series.
    """
    frequency = frequency_of(frequency)
    place = frequency.place
    columns = kept_measurements(df.columns, main)
    rules = {c: RULES[c] for c in columns} | {c: "max" for c in _reported(columns)}
    buckets = bucket_aggregate(encode_reports(df, columns, keys, time), rules, frequency, keys, time)
    checked = buckets.select(*keys, *frequency.carried, BUCKET, *[
        whole_code(F.col(c)).alias(c) if c in CHECKED_CODE_COLUMNS else F.col(c) for c in [*columns, *_reported(columns)]])
    carried = [c for c in columns if c not in INDICATOR_COLUMNS] + _reported(columns)
    series = with_neighbours(checked, BUCKET, carried, keys, CHUNK_BUCKETS)
    # Only plain numbers pass the expansion: the value at the bucket and, for a line, its change per bucket.
    known = series.select(
        *keys, *frequency.carried, BUCKET, NEXT_POSITION, FIRST_POSITION,
        *[x for c in columns for x in _known(c, place)])
    here = F.col("__grid")

    def filled(c: str) -> list[Column]:
        if c in INDICATOR_COLUMNS:
            value = F.coalesce(F.when(here == F.col(BUCKET), F.col(c)), F.lit(0.0))
            return [F.when(F.col(_REPORTED + c), value).alias(c)]
        if c in MEAN_COLUMNS:
            return [(F.col(c) + F.col(f"__slope_{c}") * (place(here) - place(F.col(BUCKET)))).alias(c)]
        if c == DIRECTION_COLUMN:
            sine, cosine = cyclical(F.col(c), 360)
            return [sine.alias(f"{c}_sin"), cosine.alias(f"{c}_cos")]
        return [F.col(c)]

    # The direction's two columns come last.
    ordered = [c for c in columns if c != DIRECTION_COLUMN] + [c for c in columns if c == DIRECTION_COLUMN]
    start = [frequency.label(F.col(FIRST_POSITION)).alias(SERIES_START)] if with_start else []
    return expand_gaps(known).select(
        *keys, frequency.label(here).alias(time), *[x for c in ordered for x in filled(c)], *start)


def _reported(columns: Sequence[str]) -> list[str]:
    return [_REPORTED + c for c in columns if c in INDICATOR_COLUMNS]


def _known(c: str, place: Place) -> list[Column]:
    if c in INDICATOR_COLUMNS:
        # A station that never reports the measurement has no indicator either.
        return [F.col(c), forward_backward(_REPORTED + c).isNotNull().alias(_REPORTED + c)]
    if c in MEAN_COLUMNS:
        return [linear(c, BUCKET, place).alias(c), slope(c, place).alias(f"__slope_{c}")]
    return [forward_backward(c).alias(c)]
