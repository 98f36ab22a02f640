"""Column descriptions and units, as field metadata and as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Description and unit of every report column.
_REPORT = {
    "station": ("Station Identifier", ""),
    "valid": ("Observation Timestamp", ""),
    "tmpf": ("Air Temperature", "°F"),
    "dwpf": ("Dew Point Temperature", "°F"),
    "relh": ("Relative Humidity", "%"),
    "drct": ("Wind Direction from True North", "°"),
    "sknt": ("Wind Speed", "kt"),
    "p01i": ("Precipitation over 1h", "in"),
    "alti": ("Pressure Altimeter", "inHg"),
    "mslp": ("Sea Level Pressure", "mbar"),
    "vsby": ("Visibility", "mi"),
    "gust": ("Wind Gust", "kt"),
    **{f"skyc{i}": (f"Sky Level {i} Coverage Code", "") for i in (1, 2, 3, 4)},
    **{f"skyl{i}": (f"Sky Level {i} Altitude", "ft") for i in (1, 2, 3, 4)},
    "wxcodes": ("Present Weather Codes", ""),
    "feel": ("Apparent Temperature", "°F"),
    **{f"ice_accretion_{i}hr": (f"Ice Accretion over {i}h", "in") for i in (1, 3, 6)},
    "peak_wind_gust": ("Peak Wind Gust", "kt"),
    "peak_wind_drct": ("Peak Wind Gust Direction", "°"),
    "peak_wind_time": ("Peak Wind Gust Time", ""),
    "metar": ("Unprocessed Reported Observation in METAR Format", ""),
    "snowdepth": ("Snow Depth (Missing)", ""),
}

# What preprocessing adds to a description, and the columns it leaves.
_CODED = " (CLR/FEW/SCT/BKN/OVC/VV ordinal encoding)"
_CLEAN_COLUMNS = ("valid", "tmpf", "dwpf", "relh", "sknt", "p01i", "vsby", "gust", "skyc1", "skyc2", "skyc3",
                  "skyl1", "skyl2", "skyl3", "feel")


def descriptions(preprocessed: bool = False, units: bool = False) -> dict[str, str]:
    """Description of every column of fetched or preprocessed data, with the unit if asked."""
    chosen = {c: _REPORT[c] for c in (_CLEAN_COLUMNS if preprocessed else _REPORT)}
    if preprocessed:
        for c in ("skyc1", "skyc2", "skyc3"):
            chosen[c] = (chosen[c][0] + _CODED, "")
        for part, word in (("sin", "sine"), ("cos", "cosine")):
            chosen[f"drct_{part}"] = (f"{_REPORT['drct'][0]} ({word} cyclical encoding)", "")
    return {c: f"{text} [{unit}]" if units and unit else text for c, (text, unit) in chosen.items()}


def described(df: DataFrame, preprocessed: bool = False, units: bool = False) -> DataFrame:
    """The frame with each description in its field's metadata."""
    known = descriptions(preprocessed, units)
    return df.select(*[
        F.col(c).alias(c, metadata={**df.schema[c].metadata, "description": known[c]}) if c in known else F.col(c)
        for c in df.columns])


def describe_columns(df: DataFrame, preprocessed: bool = False, units: bool = False) -> DataFrame:
    """One row per described column of the frame: description, type, present values."""
    known = descriptions(preprocessed, units)
    named = [(c, kind) for c, kind in df.dtypes if c in known]
    counts = df.agg(*[F.count(c).alias(c) for c, _ in named])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(known[c]).alias("description"), F.lit(kind).alias("type"),
                 F.col(c).alias("present")) for c, kind in named])))
