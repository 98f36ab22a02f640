"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read again as the next one's input.

Each stage takes (spark, docs, sf_dir) and works on all rows it gets. All but the last return the columns of documents; the
last adds ``taken``, the words of a document that the mix takes. Rows may have nulls, repeat, or be none at all: see the
operators for what that means in each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm import decontaminate, language, mixing, nearcopies, pseudonyms
from gustline.storage import materialize

#: Production keys come from a secret store; the registered pipeline needs the same pseudonyms in every run.
PSEUDONYM_KEY = b"gustline pseudonyms, corpus pipeline"
#: Texts whose language is less sure than this are rejected: those without letters, or in no language of the corpus.
LEAST_SCORE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns the languages from the documents that have one; rejects documents without a known language."""
    return language.accept(docs, language.fit(docs), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of texts with 0.8 or more of their five-word shingles in common."""
    return nearcopies.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms; n_chars follows the text."""
    done = pseudonyms.private(docs, PSEUDONYM_KEY)
    if "n_chars" not in done.columns:
        return done
    return done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the mix of sources takes, and says how many words of each."""
    return mixing.mixed(docs, F.array("source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal_data), ("mixture", mixture)]

#: The stages learn, hash and permute; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
