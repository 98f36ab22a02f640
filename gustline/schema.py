"""Table schemas, column groups and per-column rules."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ("network", "station")

# Column names of a fetched report, in file order, by type.
_REPORT_COLUMNS = (
    ("station", "string"), ("valid", "timestamp"),
    ("tmpf", "double"), ("dwpf", "double"), ("relh", "double"), ("drct", "double"), ("sknt", "double"),
    ("p01i", "double"), ("alti", "double"), ("mslp", "double"), ("vsby", "double"), ("gust", "double"),
    ("skyc1", "string"), ("skyc2", "string"), ("skyc3", "string"), ("skyc4", "string"),
    ("skyl1", "double"), ("skyl2", "double"), ("skyl3", "double"), ("skyl4", "double"),
    ("wxcodes", "string"),
    ("ice_accretion_1hr", "double"), ("ice_accretion_3hr", "double"), ("ice_accretion_6hr", "double"),
    ("peak_wind_gust", "double"), ("peak_wind_drct", "double"), ("peak_wind_time", "string"),
    ("feel", "double"), ("metar", "string"), ("snowdepth", "double"),
)

# The seven main measurements, and the further ones a full clean keeps.
MAIN_COLUMNS = ("tmpf", "dwpf", "relh", "sknt", "skyc1", "skyl1", "feel")
EXTRA_COLUMNS = ("drct", "p01i", "vsby", "gust", "skyc2", "skyc3", "skyl2", "skyl3")

# Sky cover codes in rising order; the code's rank is its encoded value.
SKY_CODES = ("CLR", "FEW", "SCT", "BKN", "OVC", "VV")

# How each measurement is reduced to one value per time bucket.
MEAN_COLUMNS = ("tmpf", "dwpf", "relh", "sknt", "vsby", "feel")
SKY_CODE_COLUMNS = ("skyc1", "skyc2", "skyc3", "skyc4")
SKY_LEVEL_COLUMNS = ("skyl1", "skyl2", "skyl3", "skyl4")
INDICATOR_COLUMNS = ("p01i", "gust")
DIRECTION_COLUMN = "drct"
# Code columns whose decimal medians are voided before filling.
CHECKED_CODE_COLUMNS = ("skyc1", "skyc2", "skyc3")

RULES = {
    **dict.fromkeys(MEAN_COLUMNS, "mean"),
    **dict.fromkeys(SKY_CODE_COLUMNS, "code_median"),
    **dict.fromkeys(SKY_LEVEL_COLUMNS + (DIRECTION_COLUMN,), "median"),
    **dict.fromkeys(INDICATOR_COLUMNS, "max"),
}

_SPARK_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "timestamp": T.TimestampNTZType()}


def _struct(pairs) -> T.StructType:
    return T.StructType([T.StructField(name, _SPARK_TYPES[kind]) for name, kind in pairs])


REPORT = _struct(_REPORT_COLUMNS)
OBSERVATIONS = T.StructType([T.StructField("network", T.StringType())] + REPORT.fields)
NETWORKS = _struct((("network", "string"), ("network_name", "string")))
# Dates of service are years in the file.
STATION_FILE = _struct((
    ("elevation", "double"), ("sname", "string"), ("state", "string"), ("country", "string"),
    ("tzname", "string"), ("county", "string"), ("sid", "string"), ("network", "string"),
    ("start", "string"), ("end", "string"), ("lat", "double"), ("lon", "double"),
))
FIRES = _struct((
    ("network", "string"), ("country", "string"), ("state", "string"), ("location", "string"),
    ("lat", "double"), ("lon", "double"), ("start", "timestamp"), ("end", "timestamp"),
    ("spread", "double"), ("cause", "string"),
))

# The key columns each dimension keeps in its short form.
SHORT_NETWORK = ("network",)
SHORT_STATION = ("sid", "network")
SHORT_FIRE = ("network", "lat", "lon", "spread", "start", "end")


def report_type(column: str) -> str | None:
    """Spark type name of a report column, None if there is no such column."""
    return dict(_REPORT_COLUMNS).get(column)


def preprocessed_schema(columns) -> T.StructType:
    """Schema of a cleaned or scaled table: keys, time and doubles."""
    return T.StructType(
        [T.StructField(k, T.StringType()) for k in KEYS]
        + [T.StructField("valid", T.TimestampNTZType())]
        + [T.StructField(c, T.DoubleType()) for c in columns]
    )
