"""Quantiles, profiles, scalers, holdout sets."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import table
from gustline.operators import holdout, profile, scale
from gustline.operators import quantiles as Q


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 0.9999999999999999, 1.0000000000000002,
         2.0, 4.0, 1.7976931348623157e308, -1.7976931348623157e308, 0.1, 1e22, 1e-300, -3.0, 2.0 ** 0.5, 1 / 3]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e3, 1e3, width=32), st.sampled_from(EDGES[:11])),
                min_size=1, max_size=60), st.sampled_from([1, 8]))
def test_quantiles_equal_numpy(spark, values, bits):
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    old, Q.CELL_BITS = Q.CELL_BITS, bits
    try:
        df = spark.createDataFrame([("g", v) for v in values], "k string, v double")
        found = Q.exact_quantiles(df, ["k"], "v", probabilities).collect()
    finally:
        Q.CELL_BITS = old
    present = [v for v in values if v is not None]
    if not present:
        assert not found
    else:
        assert found[0]["rows"] == len(present)
        assert np.allclose(found[0]["quantiles"], np.quantile(present, probabilities), atol=1e-9)


def test_cells_and_parts_rise_with_the_value(spark):
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 1 << 63, 3000, np.uint64)
    values = np.concatenate([EDGES, [np.inf, -np.inf], bits.view(np.float64), -bits.view(np.float64), rng.normal(size=500)])
    values = np.sort(values[~np.isnan(values)])
    cell, inside = Q._placed(F.col("v"))
    got = spark.createDataFrame([(float(v),) for v in values], "v double").coalesce(1).select(
        cell.alias("c"), F.floor(inside * float(1 << Q.PART_BITS)).alias("p")).collect()
    places = [(r.c, r.p) for r in got]
    assert places == sorted(places)
    # What is left in a part are the last bits of the fraction.
    assert len(set(places)) > 0.99 * len(set(values.tolist())) - 5


def test_quantiles_of_a_hot_group_with_coarse_cells(spark, monkeypatch):
    """Few cells, so that most values are told apart by their parts and within them."""
    monkeypatch.setattr(Q, "CELL_BITS", 1)
    monkeypatch.setattr(Q, "PART_BITS", 3)
    rng = random.Random(2)
    data = [("hot", rng.choice([7.0, rng.gauss(0, 1), rng.expovariate(1)])) for _ in range(20_000)] + [("cold", 1.0)]
    found = {r.k: r for r in Q.exact_quantiles(
        spark.createDataFrame(data, "k string, v double").repartition(16), ["k"], "v", [0.1, 0.5, 0.99]).collect()}
    hot = [v for k, v in data if k == "hot"]
    assert np.allclose(found["hot"].quantiles, np.quantile(hot, [0.1, 0.5, 0.99]))
    assert found["hot"].mean == pytest.approx(np.mean(hot)) and found["hot"].deviation == pytest.approx(np.std(hot, ddof=1))
    assert found["cold"].quantiles == [1.0] * 3 and found["cold"].deviation is None


def test_scalers_on_a_constant_column(obs):
    df = obs([("a", "2024-01-01 00:00", 2.0, 1.0), ("a", "2024-01-01 01:00", 2.0, 3.0)], ["tmpf", "dwpf"])
    assert table(scale.scale(df)[0].select("tmpf", "dwpf"), "dwpf") == [(0.0, 0.0), (0.0, 1.0)]
    assert table(scale.scale(df, "standard")[0].select("tmpf", "dwpf"), "dwpf") == [(0.0, -1.0), (0.0, 1.0)]


def test_scaler_options(obs):
    df = obs([("a", "2024-01-01 00:00", 1.0), ("a", "2024-01-01 01:00", 3.0), ("a", "2024-01-01 02:00", None)], ["tmpf"])
    wide, params = scale.scale(df, feature_range=(-1, 1), clip=True)
    assert table(wide.select("tmpf"), "valid") == [(-1.0,), (1.0,), (None,)]
    later = obs([("a", "2024-02-01 00:00", 9.0)], ["tmpf"])
    assert table(scale.apply_scaler(later, params).select("tmpf")) == [(1.0,)]
    plain, _ = scale.scale(df, "standard", with_mean=False, with_std=False)
    assert table(plain.select("tmpf"), "valid") == [(1.0,), (3.0,), (None,)]
    with pytest.raises(ValueError):
        scale.fit_scaler(df, "robust")


def test_apply_keeps_the_columns_and_order_of_the_fit(obs):
    df = obs([("a", "2024-01-01 00:00", 1.0, 2.0), ("a", "2024-01-01 01:00", 2.0, 4.0)], ["tmpf", "dwpf"])
    params = scale.fit_scaler(df.select("network", "station", "valid", "dwpf", "tmpf"))
    other = obs([("a", "2024-01-01 00:00", 5.0, 3.0)], ["feel", "dwpf"])
    found = scale.apply_scaler(other, params)
    assert found.columns == ["network", "station", "valid", "dwpf"] and found.first().dwpf == 0.5
    assert scale.apply_scaler(df, params).columns[-2:] == ["dwpf", "tmpf"]


def test_scaler_store_reuses_and_refits(obs, tmp_path):
    first = obs([("a", "2024-01-01 00:00", 0.0), ("a", "2024-01-01 01:00", 10.0)], ["tmpf"])
    second = obs([("a", "2024-01-01 00:00", 0.0), ("a", "2024-01-01 01:00", 20.0), ("b", "2024-01-01 00:00", 4.0)], ["tmpf"])
    path = str(tmp_path / "scalers")

    def scales(df, **options):
        return dict(table(scale.stored_scaler(df, path, "minmax", "main", **options).select("station", "scale")))

    assert scales(first) == {"a": 10.0}
    assert scales(second) == {"a": 10.0, "b": 1.0}
    assert scales(second, refit=True) == {"a": 20.0, "b": 1.0}
    assert scales(first) == {"a": 20.0, "b": 1.0}
    assert table(scale.stored_scaler(first, path, "standard").select("scale")) == [(5.0,)]


def test_gates(spark):
    df = spark.createDataFrame([(float(i), str(i % 3), str(i), None) for i in range(500)], "a double, b string, c string, d double")
    found = {r.column: tuple(r)[1:] for r in profile.column_gates(df, df.columns).collect()}
    assert found == {"a": (True, False, False), "b": (False, True, False), "c": (False, False, False), "d": (True, True, True)}
    edge = spark.createDataFrame([(str(i),) for i in range(51)], "x string")
    assert not profile.column_gates(edge, ["x"]).first().has_few_values
    assert profile.column_gates(edge.where("x <> '0'"), ["x"]).first().has_few_values


def test_histogram_counts_every_value(spark):
    rng = random.Random(4)
    values = [rng.gauss(0, 1) for _ in range(500)] + [None]
    df = spark.createDataFrame([(v, 3.0) for v in values], "x double, same double")
    found = profile.histogram(df, ["x", "same"])
    sums = {r.column: r.n for r in found.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    assert sums == {"x": 500, "same": 501}
    present = [v for v in values if v is not None]
    edges = np.histogram_bin_edges(present, bins="auto")
    bins = {r.column: r for r in profile.histogram_bins(profile.summaries(df, ["x", "same"])).collect()}
    assert bins["x"]["bins"] == len(edges) - 1
    counts, _ = np.histogram(present, bins=edges)
    assert [r.n for r in found.where("column = 'x'").orderBy("bin").collect()] == [c for c in counts if c]


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(i % 17),) for i in range(300)], "x double")
    rows = profile.density(df, ["x"]).orderBy("point").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.density for r in rows])
    assert abs(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum() - 1) < 5e-3


def test_box_of_known_values(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    r = profile.box_stats(df, ["x"]).first()
    assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.outliers) == (3.0, 5.0, 7.0, 1.0, 8.0, 1)
    assert table(profile.outliers(df, ["x"]).select("value", "n")) == [(100.0, 1)]


def test_seasons_need_whole_years(spark):
    def months(count, skip=()):
        rows = [(f"{2018 + m // 12}-{m % 12 + 1:02d}-15 00:00:00", float(m)) for m in range(count) if m not in skip]
        return spark.createDataFrame(rows, "t string, x double").selectExpr("cast(t as timestamp_ntz) as valid", "x")

    whole = table(profile.seasonal_months(months(24), ["x"]).select("month", "year", "value", "season_mean"), "month", "year")
    assert len(whole) == 24 and whole[0] == (1, 2018, 0.0, 6.0)
    assert profile.seasonal_quarters(months(24), ["x"]).count() == 8
    for frame in (months(12), months(24, skip=(5,)), months(11)):
        assert profile.seasonal_months(frame, ["x"]).count() == 0
    assert profile.monthly(months(24, skip=(5,)), ["x"]).count() == 23


@pytest.mark.parametrize("size", [0.0, 0.1, 0.25, 0.5, 1.0])
def test_exact_test_share(spark, size):
    df = spark.range(997).withColumnRenamed("id", "k")
    marked = holdout.mark_test(df, "k", size, 3, exact=True)
    assert marked.count() == 997
    assert marked.where("is_test").count() == math.ceil(997 * size)


def test_split_is_stable_and_separates_labels(spark):
    df = spark.range(1000).selectExpr("id as k", "id * 2 as a", "id % 2 as y")
    parts = holdout.train_test(df, "k", ["y"], test_size=0.3, seed=5)
    again = holdout.train_test(df.repartition(7), "k", ["y"], test_size=0.3, seed=5)
    assert [p.columns for p in parts] == [["k", "a"], ["k", "a"], ["k", "y"], ["k", "y"]]
    for p, q in zip(parts, again):
        assert table(p, "k") == table(q, "k")
    assert parts[0].count() + parts[1].count() == 1000 and 230 < parts[1].count() < 370
    assert parts[1].join(parts[3], "k").count() == parts[1].count()
