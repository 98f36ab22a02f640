"""Every registered query runs; those with SQL give the same rows as DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, FOLDER).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(frame)
    else:
        assert difference(frame, con.execute(sql).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
