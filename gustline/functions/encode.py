"""Encoders: sky codes to ranks, indicators, angles to sine and cosine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.schema import SKY_CODES


def ordinal_code(code: Column, codes=SKY_CODES) -> Column:
    """Rank of the code in the list after spaces are removed; unknown codes give null."""
    known = F.array(*[F.lit(c) for c in codes])
    place = F.array_position(known, F.replace(code, F.lit(" "), F.lit("")))
    return (F.nullif(place, F.lit(0).cast("bigint")) - 1).cast("double")


def whole_code(value: Column, codes=SKY_CODES) -> Column:
    """The value if it is exactly one of the ranks, else null."""
    return F.when((value == F.floor(value)) & value.between(0, len(codes) - 1), value)


def positive_indicator(value: Column) -> Column:
    """1 where the value is above zero, else 0; a missing value counts as 0."""
    return F.coalesce((value > 0).cast("double"), F.lit(0.0))


def cyclical(value: Column, max_value: float) -> tuple[Column, Column]:
    turn = F.lit(2.0) * F.pi() * value / F.lit(float(max_value))
    return F.sin(turn), F.cos(turn)


def encode_cyclical(df: DataFrame, column: str, max_value: float) -> DataFrame:
    """Replace the column by its sine and cosine, at the end of the frame."""
    sine, cosine = cyclical(F.col(column), max_value)
    kept = [F.col(c) for c in df.columns if c != column]
    return df.select(*kept, sine.alias(f"{column}_sin"), cosine.alias(f"{column}_cos"))
