"""Dimension rows out of documents: link or option lists in pages, station features in GeoJSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.text import period_parts, single_spaced, without_spaces

# The station features' properties, those kept only on request, and the type of a document.
_KEPT = ("elevation", "sname", "state", "country", "tzname", "county", "sid", "network")
_ON_REQUEST = ("climate_site", "wfo", "ncdc81", "ncei91", "ugc_county", "ugc_zone")
GEOJSON = (
    "count bigint, features array<struct<properties: struct<elevation: double, "
    + ", ".join(f"{c}: string" for c in (*_KEPT[1:], "time_domain", *_ON_REQUEST))
    + ">, geometry: struct<coordinates: array<double>>>>"
)


def _plain(html: Column) -> Column:
    """Text of a piece of HTML: tags removed, the common entities decoded."""
    text = F.regexp_replace(html, "<[^>]*>", "")
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def html_pairs(pages: DataFrame, html: str, tag: str = "option", attribute: str = "value", keep=()) -> DataFrame:
    """(keep..., position, value, text) for every such element of every page, in page order."""
    element = rf'(?is)<{tag}\b[^>]*?\b{attribute}\s*=\s*"([^"]*)"[^>]*>(.*?)</{tag}>'
    found = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(element), F.lit(1)).alias("value"),
        F.regexp_extract_all(html, F.lit(element), F.lit(2)).alias("text"))
    return pages.select(*keep, F.posexplode(found).alias("position", "pair")).select(
        *keep, "position", _plain(F.col("pair")["value"]).alias("value"), _plain(F.col("pair")["text"]).alias("text"))


def network_options(pages: DataFrame, html: str) -> DataFrame:
    """Network code and name from the option list of a selection page."""
    return html_pairs(pages, html).select(F.col("value").alias("network"), F.col("text").alias("network_name"))


def geojson_stations(documents: DataFrame, document: str, extra_columns: bool = False) -> DataFrame:
    """One row per station feature; ``start`` and ``end`` are year texts, an open end is empty."""
    features = documents.select(F.explode(F.from_json(F.col(document), GEOJSON)["features"]).alias("f"))
    p, at = F.col("f.properties"), F.col("f.geometry.coordinates")
    start, end = period_parts(p["time_domain"])
    tidy = {"sname": single_spaced, "state": without_spaces, "country": without_spaces}
    names = _KEPT + (_ON_REQUEST if extra_columns else ())
    return features.select(
        *[tidy.get(c, lambda x: x)(p[c]).alias(c) for c in names],
        start.alias("start"), end.alias("end"), at[1].alias("lat"), at[0].alias("lon"))


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables; columns that some lack are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
