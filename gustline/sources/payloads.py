"""Landed service payloads: CSV texts to typed reports, and the requests that produce them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.schema import REPORT

# Columns the parse leaves out unless asked, and the prefix of a refused request.
_LEFT_OUT = ("metar", "snowdepth")
_REFUSED = "ERROR"
# Code of each report kind in a request; any other name asks for all.
REPORT_CODES = {"frequent": 1, "combined": 2, "routine": 3, "special": 4}
# A cell after a comma; a quoted one may hold commas and doubled quotes.
_CELL = r',("(?:[^"]|"")*"|[^,]*)'


def _with_cells(df: DataFrame, line: str, name: str) -> DataFrame:
    """Add the cells of a CSV line as an array, however many there are; quoted commas do not split."""
    text = F.col(line)

    def plain(cell: Column) -> Column:
        body = F.replace(F.substring(cell, F.lit(2), F.greatest(F.length(cell) - 2, F.lit(0))),
                         F.lit('""'), F.lit('"'))
        return F.when(F.startswith(cell, F.lit('"')) & F.endswith(cell, F.lit('"')) & (F.length(cell) > 1), body).otherwise(cell)

    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(_CELL), F.lit(1)), plain)
    # Lines without a quote, nearly all, are split at commas.
    return df.withColumn(name, F.when(F.contains(text, F.lit('"')), quoted).otherwise(F.split(text, ",", -1)))


def parse_payloads(df: DataFrame, payload: str = "payload", keep: Sequence[str] = (), extra_columns: bool = False,
                   line_number: str | None = "src_seq", also: dict[str, str] | None = None) -> DataFrame:
    """Rows of every accepted payload, typed as reports, columns found by the payload's own header line.

    Refused payloads give no rows. ``keep`` names columns to carry along, ``line_number`` the place of the
    row in its payload, ``also`` further payload columns and their types.
    """
    names = [(f.name, f.dataType.simpleString()) for f in REPORT.fields if extra_columns or f.name not in _LEFT_OUT]
    names = [(n, k) for n, k in [*names, *(also or {}).items()] if n not in keep]
    accepted = df.where(~F.startswith(F.col(payload), F.lit(_REFUSED)))
    texts = accepted.select(*keep, F.split(F.regexp_replace(payload, "\r", ""), "\n").alias("__lines"))
    headed = _with_cells(texts.withColumn("__first", F.col("__lines")[0]), "__first", "__head")
    # Places of the columns are looked up once per payload.
    placed = headed.select(*keep, "__lines", *[
        F.nullif(F.array_position("__head", n), F.lit(0).cast("bigint")).cast("int").alias(f"__at_{n}") for n, _ in names])
    lines = placed.select(*keep, *[f"__at_{n}" for n, _ in names], F.posexplode("__lines").alias("__line", "__text"))
    parsed = _with_cells(lines.where((F.col("__line") > 0) & (F.col("__text") != "")), "__text", "__cells")

    def cell(name: str, kind: str) -> Column:
        text = F.nullif(F.trim(F.try_element_at("__cells", F.col(f"__at_{name}"))), F.lit(""))
        value = text if kind == "string" else text.try_cast(kind)
        return (F.nanvl(value, F.lit(None)) if kind == "double" else value).alias(name)

    number = [(F.col("__line") - 1).cast("bigint").alias(line_number)] if line_number else []
    return parsed.select(*keep, *[cell(n, k) for n, k in names], *number)


def _stamp(number: int, time: Column) -> Column:
    parts = (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"), ("minute", "mm"))
    pieces = [x for name, pattern in parts for x in (F.lit(f"{name}{number}="), F.date_format(time, pattern), F.lit("&"))]
    return F.concat(*pieces)


def _address(base: str, since: datetime, until: datetime, report: str, timezone: str, trace: bool, latlon: bool,
             elevation: bool) -> Column:
    fixed = base + "data=all&"
    if report in REPORT_CODES:
        fixed += f"report_type={REPORT_CODES[report]}&"
    fixed += f"tz={timezone}&format=onlycomma&missing=empty&"
    fixed += "" if trace else "trace=empty&"
    fixed += ("latlon=yes&" if latlon else "") + ("elev=yes&" if elevation else "")
    times = [F.lit(str(t)).cast("timestamp_ntz") for t in (since, until)]
    return F.concat(F.lit(fixed), _stamp(1, times[0]), _stamp(2, times[1]))


def request_manifest(stations: DataFrame, base: str, since, until, report: str = "", timezone: str = "Etc/UTC",
                     trace: bool = False, latlon: bool = False, elevation: bool = False) -> DataFrame:
    """One request address per station, for whatever downloads them."""
    address = _address(base, since, until, report, timezone, trace, latlon, elevation)
    return stations.select("network", "sid", F.concat(address, F.lit("&station="), F.col("sid")).alias("request"))


def request_all(spark: SparkSession, base: str, since, until, **options) -> DataFrame:
    """The one request for all stations; no row if the range is longer than a day."""
    settings = {"report": "", "timezone": "Etc/UTC", "trace": False, "latlon": False, "elevation": False, **options}
    span = [F.lit(str(t)).cast("timestamp_ntz") for t in (since, until)]
    return spark.range(1).where(F.timestamp_diff("MICROSECOND", *span) <= 86_400_000_000).select(
        _address(base, since, until, **settings).alias("request"))
