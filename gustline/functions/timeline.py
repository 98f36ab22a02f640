"""Timestamps, time buckets and conversions between times, text and years. Times are naive."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "s": 1, "sec": 1, "second": 1, "min": 60, "t": 60, "minute": 60,
    "h": 3600, "hour": 3600, "d": 86400, "day": 86400,
}


def step_seconds(frequency: str | int) -> int:
    """Length of a fixed bucket: ``"1 hour"``, ``"30min"``, ``"H"`` or a number of seconds."""
    if isinstance(frequency, int):
        seconds = frequency
    else:
        found = re.fullmatch(r"\s*(\d*)\s*([a-zA-Z]+?)(?<!^)s?\s*|\s*([a-zA-Z])\s*", frequency)
        if not found:
            raise ValueError(f"unknown frequency {frequency!r}")
        unit = (found.group(2) or found.group(3)).lower()
        if unit not in _UNITS:
            raise ValueError(f"unknown frequency {frequency!r}")
        seconds = int(found.group(1) or 1) * _UNITS[unit]
    if seconds <= 0:
        raise ValueError("frequency must be positive")
    return seconds


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def epoch_micros(time: Column) -> Column:
    """Microseconds since 1970 on the naive clock, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", _epoch(), time.cast("timestamp_ntz"))


def bucket_number(time: Column, step: int) -> Column:
    return F.floor(epoch_micros(time) / F.lit(step * 1_000_000))


def bucket_start(time: Column, step: int) -> Column:
    """Start of the bucket, counted from 1970; the cheap form for raw rows."""
    return F.window(time.cast("timestamp_ntz"), f"{step} seconds")["start"]


def bucket_time(bucket: Column, step: int) -> Column:
    return at_seconds(bucket * F.lit(step))


def at_seconds(seconds: Column) -> Column:
    """Naive timestamp that many whole seconds after 1970."""
    zero = F.lit(0)
    return _epoch() + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def from_year(year: Column) -> Column:
    """Start of a year given as text or number; empty text gives null."""
    number = F.nullif(F.trim(year.cast("string")), F.lit("")).cast("int")
    return F.make_date(number, F.lit(1), F.lit(1)).cast("timestamp_ntz")


def to_year(time: Column) -> Column:
    return F.date_format(time, "yyyy")


def compact_stamp(time: Column) -> Column:
    return F.date_format(time, "yyyyMMddHHmm")


def month_name(time: Column) -> Column:
    return F.date_format(time, "MMM")


def month_angle(time: Column) -> Column:
    """Angle of the calendar month on a circle that starts at January."""
    return (F.month(time) - 1) * (2 * F.pi()) / 12


def days_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(86_400_000_000)


# Accepted spellings of a date in a selection file.
_DATE_FORMATS = ("yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy")


def parse_date(text: Column) -> Column:
    """First spelling that fits; null if none does."""
    clean = F.trim(text)
    return F.coalesce(*[F.try_to_timestamp(clean, F.lit(f)).cast("timestamp_ntz") for f in _DATE_FORMATS])
