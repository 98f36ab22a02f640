"""Small text clean-ups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def single_spaced(text: Column) -> Column:
    """Each pair of spaces becomes one."""
    return F.replace(text, F.lit("  "), F.lit(" "))


def period_parts(text: Column) -> tuple[Column, Column]:
    """``(1990-Now)`` to its start and end; an end of ``Now`` gives empty text."""
    parts = F.split(F.regexp_replace(text, "[()]", ""), "-")
    return parts[0], F.replace(F.get(parts, F.lit(1)), F.lit("Now"), F.lit(""))


def capitalised(text: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def code_upper(text: Column) -> Column:
    return F.upper(F.trim(text))
