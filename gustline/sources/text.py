"""Plain files: item lists, selection lists, JSON documents, number matrices, and choice by extension."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.functions.text import code_upper
from gustline.functions.timeline import parse_date

# File kinds by extension; anything else is an item list.
_KINDS = {".csv": "table", ".json": "json", ".html": "text", ".parquet": "parquet"}


# --- items -------------------------------------------------------------------------------------------

def _pieces(text: Column, sep: str) -> Column:
    return F.filter(F.split(text, ""), lambda x: x != "") if sep == "" else F.split(text, "\\Q" + sep + "\\E")


def parse_items(lines: DataFrame, sep: str = " ", strip: str = " ", keep_empty: bool = False,
                column: str = "value") -> DataFrame:
    """Lines of text to ``values``, the parts of each item; empty items are dropped unless kept."""
    text = F.btrim(F.col(column), F.lit(strip)) if strip else F.col(column)
    items = lines.select(text.alias("__item"))
    if not keep_empty:
        items = items.where(F.col("__item") != "")
    return items.select(_pieces(F.col("__item"), sep).alias("values"))


def read_items(spark: SparkSession, path: str, end: str = "\n", sep: str = " ", strip: str = " ",
               keep_empty: bool = False) -> DataFrame:
    if end == "":
        characters = spark.read.text(path, wholetext=True).select(F.explode(_pieces(F.col("value"), "")).alias("value"))
        return parse_items(characters, sep, strip, keep_empty)
    return parse_items(spark.read.text(path, lineSep=end), sep, strip, keep_empty)


def write_items(df: DataFrame, path: str, column: str = "values", end: str = "\n", sep: str = " ", strip: str = " ",
                mode: str = "overwrite") -> None:
    """One item per line; an array is joined, text is written as it is."""
    value = F.concat_ws(sep, F.col(column)) if isinstance(df.schema[column].dataType, T.ArrayType) else F.col(column)
    line = F.btrim(value, F.lit(strip)) if strip else value
    df.select(line.alias("value")).write.mode(mode).option("lineSep", end).text(path)


# --- selections --------------------------------------------------------------------------------------

def selection_codes(lines: DataFrame, name: str, column: str = "value") -> DataFrame:
    """One code per line: trimmed, upper case, without empty lines."""
    return lines.select(code_upper(F.col(column)).alias(name)).where(F.col(name) != "")


def selection_dates(lines: DataFrame, name: str = "valid", column: str = "value") -> DataFrame:
    """One date per line, year or day first, with or without a time."""
    return lines.where(F.trim(F.col(column)) != "").select(parse_date(F.col(column)).alias(name))


def read_selection(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A selection file as a frame: ``network`` and ``sid`` are codes, ``valid`` is a date."""
    lines = spark.read.text(path)
    return selection_dates(lines, name) if name == "valid" else selection_codes(lines, name)


# --- JSON and matrices -------------------------------------------------------------------------------

def parse_json(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """The fields of a JSON text column beside the other columns."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.from_json(F.col(column), schema).alias("__doc")).select(*kept, "__doc.*")


def read_json(spark: SparkSession, path: str, schema: str | T.StructType, lines: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def parse_matrix(lines: DataFrame, sep: str = " ", column: str = "value") -> DataFrame:
    """Lines of numbers to an array of doubles."""
    numbers = F.transform(F.split(F.trim(F.col(column)), "\\Q" + sep + "\\E"), lambda x: x.cast("double"))
    return lines.where(F.trim(F.col(column)) != "").select(numbers.alias("values"))


def read_matrix(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    return parse_matrix(spark.read.text(path), sep)


def write_matrix(df: DataFrame, path: str, column: str = "values", sep: str = " ", mode: str = "overwrite") -> None:
    df.select(F.concat_ws(sep, F.transform(F.col(column), lambda x: x.cast("string"))).alias("value")).write.mode(mode).text(path)


# --- by extension ------------------------------------------------------------------------------------

def file_kind(path: str) -> str:
    return _KINDS.get(os.path.splitext(path.rstrip("/"))[1].lower(), "list")


def read_table(spark: SparkSession, path: str, kind: str | None = None, schema=None, **options) -> DataFrame:
    """Read by kind, or by the path's extension: table, json, parquet, text, matrix, list."""
    kind = kind or file_kind(path)
    if kind == "table":
        reader = spark.read.option("header", True).options(**options)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    if kind == "json":
        if schema is None:
            raise ValueError("a JSON file needs a schema")
        return read_json(spark, path, schema, **options)
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind == "text":
        return spark.read.text(path, wholetext=True)
    if kind == "matrix":
        return read_matrix(spark, path, **options)
    if kind == "list":
        return read_items(spark, path, **options)
    raise ValueError(f"unknown kind {kind!r}")


def write_table(df: DataFrame, path: str, kind: str | None = None, mode: str = "overwrite", **options) -> None:
    kind = kind or file_kind(path)
    if kind == "table":
        df.write.mode(mode).option("header", True).options(**options).csv(path)
    elif kind == "json":
        write_json(df, path, mode)
    elif kind == "parquet":
        df.write.mode(mode).parquet(path)
    elif kind == "text":
        df.write.mode(mode).option("lineSep", "").text(path)
    elif kind == "matrix":
        write_matrix(df, path, mode=mode, **options)
    elif kind == "list":
        write_items(df, path, mode=mode, **options)
    else:
        raise ValueError(f"unknown kind {kind!r}")
