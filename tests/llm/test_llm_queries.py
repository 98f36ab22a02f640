"""The registered queries of the subpackage and the pipeline on the smallest tables."""

import pytest

import corpus_pipeline
from gustline.llm import queries
from oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    frame = queries.QUERIES[name](spark, FOLDER).toPandas()
    if name in queries.ORACLE:
        assert difference(frame, connect(FOLDER).execute(queries.ORACLE[name]).df()) is None
    else:
        table = "pages" if name == "op3_html_text" else "documents"
        assert len(frame) == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_stages_keep_columns_and_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == names and out.dtypes == docs.dtypes, name
        assert 0 < out.count() <= rows
    last = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert last["doc_id"].is_unique and (last["taken"] > 0).all()


def test_stages_on_no_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0, name
