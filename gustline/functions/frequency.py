"""Time buckets of any width: a number of seconds, weeks, months, quarters or years.

Buckets of a fixed width are counted from the midnight before a series' first time, so a width that does not divide a day
begins anew for each series. Calendar buckets are whole weeks (Monday to Sunday), months, quarters or years; several of them
make a bucket that is counted from the period of the series' first time. ``W M Q Y`` are named by their last day, ``MS QS YS``
and the words (``"1 month"``) by their first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gustline.functions.timeline import at_seconds, bucket_time, epoch_micros, step_seconds

ORIGIN = "__origin"

# Spellings of calendar units; kind, weeks or months of a period, named by its last day.
_CALENDAR = {
    "W": ("week", 1, True), "week": ("week", 1, False),
    "M": ("month", 1, True), "ME": ("month", 1, True), "MS": ("month", 1, False), "month": ("month", 1, False),
    "Q": ("month", 3, True), "QE": ("month", 3, True), "QS": ("month", 3, False), "quarter": ("month", 3, False),
    "Y": ("month", 12, True), "YE": ("month", 12, True), "A": ("month", 12, True), "YS": ("month", 12, False),
    "AS": ("month", 12, False), "year": ("month", 12, False),
}
_DAY = 86_400


@dataclass(frozen=True)
class Frequency:
    kind: str
    #: Seconds, weeks or months of a period.
    size: int
    #: Periods of a bucket.
    times: int = 1
    ending: bool = False

    @property
    def fixed(self) -> bool:
        return self.kind == "fixed"

    @property
    def anchored(self) -> bool:
        """Whether the buckets depend on where the series begins."""
        return bool(_DAY % self.size) if self.fixed else self.times > 1

    @property
    def carried(self) -> list[str]:
        """Columns that go with a bucket's number."""
        return [ORIGIN] if self.anchored else []

    def _period(self, time: Column) -> Column:
        """Number of the week or month period that holds the time."""
        if self.kind == "week":
            # 1970 began on a Thursday.
            return F.floor((F.unix_date(time.cast("date")) + 3) / 7)
        return F.floor(((F.year(time) - 1970) * 12 + F.month(time) - 1) / self.size)

    def origin(self, first: Column) -> Column:
        """What the buckets of a series with this first time are counted from."""
        return F.unix_date(first.cast("date")).cast("bigint") * _DAY if self.fixed else self._period(first)

    def bucket(self, time: Column) -> Column:
        """Number of the time's bucket; an anchored one needs ``ORIGIN`` beside it."""
        if self.fixed:
            micros = epoch_micros(time)
            if self.anchored:
                micros = micros - F.col(ORIGIN) * 1_000_000
            return F.floor(micros / F.lit(self.size * 1_000_000))
        period = self._period(time)
        if not self.anchored:
            return period
        away = (period - F.col(ORIGIN)) / self.times
        return F.ceil(away) if self.ending else F.floor(away)

    def label(self, bucket: Column) -> Column:
        """The time that names the bucket."""
        if self.fixed:
            if self.anchored:
                return at_seconds(F.col(ORIGIN) + bucket * self.size)
            return bucket_time(bucket, self.size)
        period = F.col(ORIGIN) + bucket * self.times if self.anchored else bucket
        zero = F.make_date(F.lit(1970), F.lit(1), F.lit(1))
        if self.kind == "week":
            day = F.date_add(zero, (period * 7 - 3 + (6 if self.ending else 0)).cast("int"))
        else:
            last = self.size - 1 if self.ending else 0
            day = F.add_months(zero, (period * self.size + last).cast("int"))
            day = F.last_day(day) if self.ending else day
        return day.cast("timestamp_ntz")

    def place(self, bucket: Column) -> Column:
        """Where the bucket is in time, as a number: its own where all are equally long, seconds otherwise."""
        return bucket if self.fixed else F.floor(epoch_micros(self.label(bucket)) / 1_000_000)


def frequency_of(text: str | int | Frequency) -> Frequency:
    """``"1 hour"``, ``"5h"``, ``"2D"``, ``3600``, ``"W"``, ``"2M"``, ``"QS"``, ``"1 month"``."""
    if isinstance(text, Frequency):
        return text
    if isinstance(text, str):
        found = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", text)
        unit = found.group(2) if found else ""
        unit = unit if unit in _CALENDAR else unit.lower().removesuffix("s")
        if unit in _CALENDAR:
            kind, size, ending = _CALENDAR[unit]
            times = int(found.group(1) or 1)
            if times <= 0:
                raise ValueError("frequency must be positive")
            return Frequency(kind, size, times, ending)
    return Frequency("fixed", step_seconds(text))
