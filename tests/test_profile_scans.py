"""How often the profile's tables read their source, and their results against plain Python."""

import os
import uuid

import numpy as np
import pytest

from gustline.operators import profile, quantiles
from gustline.plans import reports


def read_counted(df, folder):
    """The frame, and a function that tells how often it was read."""
    folder = str(folder)

    def run(batches):
        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        yield from batches

    return df.coalesce(1).mapInArrow(run, df.schema), lambda: len(os.listdir(folder))


def rows(spark, n=2000):
    rng = np.random.default_rng(3)
    data = [("S%d" % (i % 3), float(rng.normal()) if i % 7 else None, float(rng.integers(0, 5)), ["a", "b", None][i % 3], f"id{i}", i % 90)
            for i in range(n)]
    return spark.createDataFrame(data, "station string, x double, y double, code string, name string, k int")


def test_box_stats_reads_three_times(spark, tmp_path):
    df, reads = read_counted(rows(spark), tmp_path)
    found = {r.column: r for r in profile.box_stats(df, ["x", "y"]).collect()}
    assert reads() <= 3
    x = np.array([r.x for r in rows(spark).collect() if r.x is not None])
    q1, q3 = np.quantile(x, [0.25, 0.75])
    inner = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    b = found["x"]
    assert (b.n, b.outliers) == (len(x), len(x) - len(inner))
    assert np.allclose([b.q1, b.q3, b.mean, b.whisker_low, b.whisker_high], [q1, q3, x.mean(), inner.min(), inner.max()])


def test_profile_reads_four_times(spark, tmp_path):
    df, reads = read_counted(rows(spark), tmp_path)
    table = reports.distribution_profile(df, ["x", "y", "code", "name"]).collect()
    assert reads() <= 4
    by = {(r.column, r.part, r.item): r.value for r in table}
    assert by["code", "category", "a"] == 667 and by["code", "missing", "missing"] == 666
    # A column of many values is not counted by category, but its cells are.
    assert by["name", "missing", "present"] == 2000 and not any(k[:2] == ("name", "category") for k in by)
    assert by["x", "missing", "missing"] == 286 and sum(v for k, v in by.items() if k[:2] == ("x", "histogram")) == 1714


def test_places_of_values_are_computed_once(spark, monkeypatch):
    """The second pass of the quantiles does not repeat the long expression of a value's cell in a null check."""
    plans = []
    write = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, name))[1])
    found = quantiles.exact_quantiles(rows(spark), ["station"], "x", [0.5]).collect()
    assert len(found) == 3 and any("LOG2" in p for p in plans)
    assert not [line for p in plans for line in p.splitlines() if "Filter" in line and "LOG2" in line]


def test_tables_by_station_are_those_of_each_station(spark):
    df = rows(spark)
    every = reports.distribution_profile(df, ["x", "y"], ["station"]).collect()
    for s in ("S0", "S1", "S2"):
        alone = {(r.column, r.part, r.item): r.value for r in reports.distribution_profile(df.where(f"station = '{s}'"), ["x", "y"]).collect()}
        mine = {(r.column, r.part, r.item): r.value for r in every if r.station == s}
        assert mine.keys() == alone.keys()
        assert all(mine[k] == pytest.approx(alone[k], rel=1e-9, abs=1e-12) for k in mine)


def test_density_far_from_all_values(spark):
    """Two lumps far apart: points out of reach of every kernel are zero, the others as the formula has them."""
    v = np.concatenate([np.arange(40) * 1e-6, 1e6 + np.arange(3) * 1e-6])
    df = spark.createDataFrame([(float(x),) for x in v], "x double").repartition(3)
    got = {r.point: r for r in profile.density(df, ["x"]).collect()}
    width = v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(v.min() - 3 * width, v.max() + 3 * width, 200)
    want = np.exp(-0.5 * ((grid[:, None] - v[None, :]) / width) ** 2).sum(1) / (len(v) * width * np.sqrt(2 * np.pi))
    assert len(got) == 200 and np.allclose([got[i].density for i in range(200)], want, atol=1e-15)


def test_distinct_counts_without_expand(spark):
    df = spark.createDataFrame([(i % 7, float(i % 5) if i % 5 else -0.0, None, f"t{i}", i % 2 == 0, [i % 3]) for i in range(500)]
                               + [(None, 0.0, None, None, None, None)],
                               "a int, b double, c string, d string, e boolean, f array<int>")
    found = profile.distinct_counts(df, df.columns)
    assert {r.column: r.distinct_values for r in found.collect()} == {"a": 7, "b": 5, "c": 0, "d": 500, "e": 2, "f": 3}
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert profile.distinct_counts(df.limit(0), ["a"]).collect() == [("a", 0)]


def test_a_task_hands_on_few_values(spark):
    df = spark.range(0, 10_000, 1, 4).selectExpr("id", "id % 3 as few")
    met = profile.values_met(df, ["id", "few"], 50)
    counts = {(r.column, r.kind): r["count"] for r in met.groupBy("column", "kind").count().collect()}
    assert counts["few", "value"] == 3 and 50 < counts["id", "value"] <= 4 * 51
    assert {r.value for r in profile.few_values(met, 50).collect()} == {"0", "1", "2"}
