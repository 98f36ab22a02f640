"""Attributes shown with a map feature: the present values of a row under display names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Display names that differ from the capitalised column name.
_DISPLAY = {
    "sname": "Name", "tzname": "Timezone", "sid": "ID", "lat": "Latitude", "latitude": "Latitude",
    "lon": "Longitude", "long": "Longitude", "lng": "Longitude", "longitude": "Longitude",
}


def display_name(column: str) -> str:
    return _DISPLAY.get(column, column[:1].upper() + column[1:].lower())


def attributes(df: DataFrame, columns: Sequence[str] | None = None, datetime_to_year: bool = False) -> Column:
    """Map of display name to text without the missing values; times as years if asked."""
    kinds = dict(df.dtypes)
    columns = [c for c in (columns or df.columns) if c in kinds]

    def text(c: str) -> Column:
        value = F.col(c)
        if datetime_to_year and kinds[c] in ("timestamp_ntz", "timestamp", "date"):
            value = F.year(value)
        return value.cast("string")

    cells = [x for c in columns for x in (F.lit(display_name(c)), text(c))]
    return F.map_filter(F.create_map(*cells), lambda _, v: v.isNotNull())
