"""Gap filling on a regular series: one row per key and time step."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.frequency import Frequency, frequency_of
from gustline.functions.timeline import epoch_micros
from gustline.operators.neighbours import NEXT_POSITION, after, before, tasks_for, with_neighbours
from gustline.operators.resample import BUCKET, CHUNK_BUCKETS, bucket_aggregate, expand_gaps
from gustline.schema import KEYS
from gustline.storage import materialize

_POSITION = "__micros"
# Rows of one station and this many days are handled together.
CHUNK_DAYS = 64


def forward(column: str) -> Column:
    return before(column)["value"]


def forward_backward(column: str) -> Column:
    return F.expr(f"coalesce(`__before_{column}`.value, `__after_{column}`.value)")


Place = Callable[[Column], Column]


def _as_is(position: Column) -> Column:
    return position


def _rise(column: str, place: Place) -> Column:
    left, right = before(column), after(column)
    return F.coalesce((right["value"] - left["value"]) / (place(right["at"]) - place(left["at"])), F.lit(0.0))


def slope(column: str, place: Place = _as_is) -> Column:
    """Change per unit of ``place`` between the neighbours, 0 where one is missing."""
    return _rise(column, place)


def linear(column: str, position: str, place: Place = _as_is) -> Column:
    """Linear between the neighbours, the nearest value at both ends. ``place`` gives a position's place in time."""
    left, right = before(column), after(column)
    between = (right["value"] - left["value"]) / (place(right["at"]) - place(left["at"])) * (place(F.col(position)) - place(left["at"]))
    return F.coalesce(left["value"] + F.coalesce(between, F.lit(0.0)), right["value"])


_METHODS = {
    "ffill": lambda c: forward(c),
    "ffill_bfill": lambda c: forward_backward(c),
    # An exact hit needs no slope; it also keeps the stored value bit by bit.
    "linear": lambda c: F.coalesce(F.col(c), linear(c, _POSITION)),
}


def _carried(methods: dict[str, str]) -> list[str]:
    unknown = set(methods.values()) - set(_METHODS) - {"zero"}
    if unknown:
        raise ValueError(f"unknown fill methods {sorted(unknown)}")
    return [c for c, m in methods.items() if m != "zero"]


def resample_filled(df: DataFrame, rules: dict[str, str], methods: dict[str, str], frequency: str | int | Frequency = "1 hour",
                    keys: Sequence[str] = KEYS, time: str = "valid") -> DataFrame:
    """Resample to the dense grid and fill. Decided on the non-empty buckets, which are expanded last: each carries its
    filled value and, for a line, its change over time, so the dense series meets no sort and no exchange."""
    frequency, carried = frequency_of(frequency), _carried(methods)
    place = frequency.place
    # Written, so that their number is known before they are dealt out.
    buckets = materialize(bucket_aggregate(df, rules, frequency, keys, time), "filled")
    near = with_neighbours(buckets, BUCKET, carried, keys, CHUNK_BUCKETS, tasks_for(buckets))

    def known(c: str) -> list[Column]:
        if methods.get(c) == "ffill":
            return [forward(c).alias(c)]
        if methods.get(c) == "ffill_bfill":
            return [forward_backward(c).alias(c)]
        if methods.get(c) == "linear":
            return [F.coalesce(F.col(c), linear(c, BUCKET, place)).alias(c), slope(c, place).alias(f"__slope_{c}")]
        return [F.col(c)]

    def filled(c: str) -> Column:
        here = F.when(F.col("__grid") == F.col(BUCKET), F.col(c))
        if methods.get(c) == "linear":
            return (F.col(c) + F.col(f"__slope_{c}") * (place(F.col("__grid")) - place(F.col(BUCKET)))).alias(c)
        if methods.get(c) == "zero":
            return F.coalesce(here, F.lit(0.0)).alias(c)
        return F.col(c) if c in methods else here.alias(c)

    grid = expand_gaps(near.select(
        *keys, *frequency.carried, BUCKET, NEXT_POSITION, *[x for c in rules for x in known(c)]))
    return grid.select(*keys, frequency.label(F.col("__grid")).alias(time), *[filled(c) for c in rules])


def fill_gaps(df: DataFrame, methods: dict[str, str], keys: Sequence[str] = KEYS, time: str = "valid",
              chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Fill columns of a series that is regular already: ``{"tmpf": "linear", "skyc1": "ffill_bfill", "gust": "zero"}``.

    From reports, :func:`resample_filled` fills without an exchange of the dense series."""
    carried = _carried(methods)
    wide = df
    if carried:
        wide = with_neighbours(df.withColumn(_POSITION, epoch_micros(F.col(time))), _POSITION, carried, keys,
                               chunk_days * 86_400_000_000)

    def filled(c: str) -> Column:
        if c not in methods:
            return F.col(c)
        if methods[c] == "zero":
            return F.coalesce(F.col(c), F.lit(0.0)).alias(c)
        return _METHODS[methods[c]](c).alias(c)

    return wide.select(*[filled(c) for c in df.columns])
