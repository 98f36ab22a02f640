"""Exact holdout within strata against sorting."""

import hashlib
import math
from collections import defaultdict

import pytest

from gustline.operators import holdout


def slowly(rows, size, seed):
    """(key, stratum) rows to the set of test keys."""
    groups = defaultdict(list)
    for key, *stratum in rows:
        groups[tuple(stratum)].append(key)
    text = lambda s: "{" + ",".join(f'"s{i}":' + ("null" if x is None else f'"{x}"') for i, x in enumerate(s)) + "}"
    share = {s: round(len(g) * size, 9) for s, g in groups.items()}
    left = math.ceil(round(len(rows) * size, 9)) - sum(map(math.floor, share.values()))
    order = sorted(groups, key=lambda s: (-(share[s] - math.floor(share[s])), text(s)))
    quota = {s: math.floor(share[s]) + (s in order[:left]) for s in groups}
    return {k for s, g in groups.items()
            for k in sorted(g, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())[:quota[s]]}


@pytest.mark.parametrize("size", [0.0, 0.01, 0.25, 0.5, 1.0])
def test_as_sorting(spark, size):
    rows = [(i, "ab"[i % 2] if i % 7 else None, str(i % 300) if i % 3 else "large") for i in range(6000)]
    df = spark.createDataFrame(rows, "k bigint, s string, t string")
    marked = holdout.mark_test_within(df, "k", ["s", "t"], size, 3)
    got = {r["k"] for r in marked.where("is_test").collect()}
    assert marked.columns == ["k", "s", "t", "is_test"] and marked.count() == 6000
    assert got == slowly(rows, size, 3) and len(got) == math.ceil(6000 * size)


def test_large_stratum_takes_more_turns(spark):
    rows = [(i, "hot" if i % 50 else "cold") for i in range(200_000)]
    df = spark.createDataFrame(rows, "k bigint, s string")
    got = {r["k"] for r in holdout.mark_test_within(df, "k", ["s"], 0.3, 1).where("is_test").collect()}
    assert got == slowly(rows, 0.3, 1)


def test_no_rows_and_parts(spark):
    df = spark.createDataFrame([], "k bigint, s string, y int")
    assert holdout.mark_test_within(df, "k", ["s"], 0.3).count() == 0
    rows = spark.createDataFrame([(i, "ab"[i % 2], i) for i in range(40)], "k bigint, s string, y int")
    x_train, x_test, y_train, y_test = holdout.train_test(rows, "k", ["y"], strata=["s"], test_size=0.25)
    assert (x_train.count(), x_test.count()) == (30, 10) == (y_train.count(), y_test.count())
    assert {r["s"]: r["count"] for r in x_test.groupBy("s").count().collect()} == {"a": 5, "b": 5}
