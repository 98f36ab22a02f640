"""Projections and row filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.schema import KEYS, MAIN_COLUMNS


def main_columns(df: DataFrame, main: Sequence[str] = MAIN_COLUMNS, keys: Sequence[str] = (*KEYS, "valid")) -> DataFrame:
    """Keys and the main columns the frame has."""
    return df.select(*[c for c in keys if c in df.columns], *[c for c in main if c in df.columns and c not in keys])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = (*KEYS, "valid")) -> DataFrame:
    """Drop columns without a single value: one aggregate, one row back to the driver."""
    tested = [c for c in df.columns if c not in keep]
    if not tested:
        return df
    seen = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in tested]).first()
    return df.select(*[c for c in df.columns if c in keep or seen[c]])


def listed(values: str | Sequence[str] | None) -> list[str] | None:
    """One code, a list of codes or nothing, as a list."""
    if values is None:
        return None
    return [values] if isinstance(values, str) else list(values)


def members(df: DataFrame, column: str, selection: str | Sequence[str] | DataFrame | None,
            selection_column: str | None = None) -> DataFrame:
    """Rows whose code is selected: by one code, a list, or a frame (semi-join; Spark sizes the join)."""
    if selection is None:
        return df
    if isinstance(selection, DataFrame):
        wanted = selection.select(F.col(selection_column or column).alias(column))
        return df.join(wanted, column, "left_semi")
    return df.where(F.col(column).isin(listed(selection)))


def _three_way(start: Column, end: Column, since: Column, until: Column) -> Column:
    # Not the usual two comparisons: with a null end only the first branch can hold.
    return (start.between(since, until) | end.between(since, until) | ((start < since) & (end > until)))


def _bound(value, default: str) -> Column:
    if value is None:
        return F.lit(default).cast("timestamp_ntz")
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def _reversed(since, until) -> bool:
    if since is None or until is None:
        return False
    as_time = [datetime.fromisoformat(str(v)) for v in (since, until)]
    return as_time[1] < as_time[0]


def overlapping(df: DataFrame, since=None, until=None, open_end: bool = False, as_of=None,
                start: str = "start", end: str = "end") -> DataFrame:
    """Rows whose interval touches [since, until], bounds included.

    ``open_end``: a missing end counts as ``as_of`` (default: now), the rule for stations. Without it a
    missing end matches only through the start, the rule for fires. A reversed range filters nothing.
    """
    if (since is None and until is None) or _reversed(since, until):
        return df
    finish = F.col(end)
    if open_end:
        now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else _bound(as_of, "")
        finish = F.coalesce(finish, now)
    return df.where(_three_way(
        F.col(start), finish, _bound(since, "0001-01-01 00:00:00"), _bound(until, "9999-12-31 23:59:59")))


def min_spread(df: DataFrame, least: float = 0, column: str = "spread") -> DataFrame:
    """Fires of at least that spread; a positive limit also drops unknown spreads."""
    return df.where(F.col(column) >= F.lit(float(least))) if least > 0 else df
