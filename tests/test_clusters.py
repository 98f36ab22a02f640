"""Splitting, smoothing, DTW and both k-means."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import table
from gustline.operators import cluster, dtw, smooth, split
from gustline.operators.running import with_row_numbers


def hourly(obs, count, stations=("a",), start=13):
    rows = [(s, f"2024-01-{1 + (start + i) // 24:02d} {(start + i) % 24:02d}:00", float(i)) for s in stations for i in range(count)]
    return obs(rows, ["tmpf"])


def test_days_are_counted_from_the_first_hour_and_padded(obs):
    found = table(split.split_series(hourly(obs, 38)).selectExpr("cast(day as string)", "values"), "day")
    assert [f[0] for f in found] == ["2024-01-01 13:00:00", "2024-01-02 13:00:00"]
    assert found[0][1] == [float(i) for i in range(24)]
    assert found[1][1] == [float(i) for i in range(24, 38)] + [37.0] * 10


def test_full_days_need_no_padding(obs):
    found = split.split_series(hourly(obs, 48, ("a", "b")))
    assert found.count() == 4 and found.where("size(values) <> 24").count() == 0


def test_unsplit_restores_the_series(obs):
    df = hourly(obs, 48)
    back = split.unsplit(split.split_series(df)).select("network", "station", "valid", F.col("value").alias("tmpf"))
    assert table(back, "valid") == table(df, "valid")


def test_rows_by_count_across_chunks(spark):
    df = spark.range(103).selectExpr("'N' as network", "id % 2 as station", "id as place", "double(id) as v")
    found = table(split.split_rows(df, ["v"], 10, order=("place",)).where("station = 1").select("row", "values"), "row")
    odd = [float(i) for i in range(1, 103, 2)]
    assert [v for _, vs in found for v in vs][:51] == odd and found[-1][1] == [odd[-1]] * 10


def test_one_series_is_numbered_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(20_000).selectExpr("'N' as k", "20000 - id as place").repartition(5)
    numbered = with_row_numbers(df, ["place"], ["k"], "n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert numbered.where("n <> place - 1").count() == 0 and numbered.count() == 20_000


def test_row_scaling(spark):
    df = spark.createDataFrame([([1.0, 3.0, None],), ([2.0, 2.0, 2.0],)], "values array<double>")
    assert table(split.scale_rows(df)) == [([0.0, 1.0, None],), ([0.0, 0.0, 0.0],)]
    assert table(split.scale_rows(df, "standard")) == [([-1.0, 1.0, None],), ([0.0, 0.0, 0.0],)]
    assert table(split.scale_rows(df, feature_range=(-1, 1), clip=True))[0] == ([-1.0, 1.0, None],)


def plain_lowess(x, y, frac, passes):
    """The published method, point by point."""
    n, k = len(x), int(frac * len(x) + 1e-10)
    robust, fit = np.ones(n), np.array(y, dtype=float)
    for turn in range(passes + 1):
        for i in range(n):
            near = np.sort(np.argsort(np.abs(x - x[i]), kind="stable")[:k])
            d = np.abs(x[near] - x[i])
            r = d.max()
            w = np.where(d <= 0.001 * r, 1.0, np.where(d > 0.999 * r, 0.0, (1 - (d / r) ** 3) ** 3)) * robust[near]
            if w.sum() <= 0:
                fit[i] = y[i]
                continue
            w = w / w.sum()
            mx, my = (w * x[near]).sum(), (w * y[near]).sum()
            sx = (w * (x[near] - mx) ** 2).sum()
            fit[i] = my + ((w * (x[near] - mx) * y[near]).sum() / sx if sx > 1e-12 else 0) * (x[i] - mx)
        e = np.abs(y - fit)
        e[e <= 1e-10 * np.abs(y).max()] = 0
        s = 6 * np.median(e)
        robust = np.where(e < s * (1 - 1e-9), (1 - (e / s) ** 2) ** 2, 0.0) if s > 0 else np.where(e > 0, 0.0, 1.0)
    return fit


@pytest.mark.parametrize("n, frac, passes", [(24, 0.4, 3), (24, 2 / 3, 0), (10, 0.5, 2), (41, 0.3, 3)])
def test_lowess_equals_the_plain_method(n, frac, passes):
    rng = np.random.default_rng(n)
    y = rng.normal(size=(6, n)) * 5 + np.sin(np.arange(n) / 4) * 20
    y[1] = 7.0
    y[2, n // 2] += 400
    x = np.arange(n, dtype=float)
    found = smooth.lowess_matrix(x, y, frac, passes)
    for row, fitted in zip(y, found):
        assert np.allclose(fitted, plain_lowess(x, row, frac, passes), atol=1e-8)


def test_lowess_leaves_missing_slots_out(spark):
    y = [float(i * i) for i in range(24)]
    gap = [None if i in (3, 11) else v for i, v in enumerate(y)]
    df = spark.createDataFrame([(0, y), (1, gap), (2, None), (3, [])], "i int, values array<double>")
    found = {r.i: r["values"] for r in smooth.smooth_rows(df, frac=0.4).collect()}
    kept = np.array([i for i in range(24) if i not in (3, 11)], dtype=float)
    expected = smooth.lowess_matrix(kept, kept[None, :] ** 2, 0.4)[0]
    assert found[1][3] is None and found[1][11] is None
    assert np.allclose([v for v in found[1] if v is not None], expected)
    assert found[2] is None and found[3] == []


def test_delta_interpolates_between_fits():
    x, y = np.arange(50, dtype=float), np.arange(50, dtype=float)[None, :] * 2
    assert np.allclose(smooth.lowess_matrix(x, y, 0.4, delta=5.0), y)


def plain_dtw(a, b):
    table_ = np.full((len(a) + 1, len(b) + 1), np.inf)
    table_[0, 0] = 0
    for i, p in enumerate(a):
        for j, q in enumerate(b):
            table_[i + 1, j + 1] = (p - q) ** 2 + min(table_[i, j], table_[i, j + 1], table_[i + 1, j])
    return table_[-1, -1] ** 0.5


def test_dtw_distances(spark):
    rng = random.Random(0)
    pairs = [([1.0, 2.0, 3.0], [1.0, 3.0, 4.0])] + [
        ([rng.random() for _ in range(rng.randint(1, 9))], [rng.random() for _ in range(rng.randint(1, 9))]) for _ in range(60)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<double>, b array<double>")
    found = table(df.select("i", dtw.dtw_distance(F.col("a"), F.col("b"))), "i")
    assert round(found[0][1], 8) == 1.41421356
    assert np.allclose([d for _, d in found], [plain_dtw(a, b) for a, b in pairs])


def test_alignment_sums():
    rng = np.random.default_rng(1)
    center, rows = rng.normal(size=(5, 6)), rng.normal(size=(5, 6))
    sums, counts = np.zeros((2, 6)), np.zeros((2, 6))
    dtw.path_sums(center, rows, np.array([0, 0, 1, 1, 1]), sums, counts)
    assert (counts >= np.array([[2], [3]])).all()
    # The mean of the aligned values is at least as near to the rows as the center was.
    for i, members in ((0, [0, 1]), (1, [2, 3, 4])):
        if len({tuple(center[m]) for m in members}) == 1:
            assert counts[i].sum() >= 6
    same = np.zeros((1, 4)), np.zeros((1, 4))
    dtw.path_sums(np.array([[1.0, 5.0, 2.0, 8.0]]), np.array([[1.0, 5.0, 2.0, 8.0]]), np.array([0]), *same)
    assert same[0].tolist() == [[1.0, 5.0, 2.0, 8.0]] and same[1].tolist() == [[1.0] * 4]


def shapes(spark, days=30):
    rng = np.random.default_rng(7)
    base = {"low": np.zeros(24), "high": np.full(24, 50.0), "wave": 20 * np.sin(np.arange(24) / 4)}
    rows = [("N", s, "tmpf", f"2024-01-{d + 1:02d}", (base[k] + rng.normal(size=24)).tolist(), k)
            for s in ("a", "b") for d in range(days) for k in [sorted(base)[d % 3]]]
    return spark.createDataFrame(rows, "network string, station string, column string, day string, values array<double>, kind string") \
        .withColumn("day", F.col("day").cast("timestamp_ntz"))


def test_dtw_kmeans_finds_the_shapes(spark):
    df = shapes(spark)
    model = cluster.fit_dtw_kmeans(df, clusters=3, seed=3, max_iter=10)
    assert model.count() == 6 and model.where("size(center) <> 24").count() == 0
    labels = cluster.assign_dtw(df, model)
    pairs = labels.groupBy("station", "kind").agg(F.count_distinct("cluster").alias("n"), F.first("cluster").alias("c"))
    assert pairs.where("n <> 1").count() == 0
    assert pairs.select("station", "c").distinct().count() == 6
    # Labels are the arg-min of the distances.
    centers = {(r.station, r.cluster): r.center for r in model.collect()}
    for r in labels.limit(20).collect():
        costs = [plain_dtw(r["values"], centers[(r.station, c)]) for c in range(3)]
        assert int(np.argmin(costs)) == r.cluster and abs(min(costs) - r.distance) < 1e-9


def test_dtw_kmeans_is_seeded_and_inertia_falls(spark):
    df = shapes(spark, 20)
    runs = [cluster.fit_dtw_kmeans(part, clusters=2, seed=1, max_iter=n).groupBy("station").agg(F.first("inertia").alias("i"))
            for part, n in ((df, 1), (df, 3), (df.repartition(5), 3))]
    one, three, again = [dict(table(r)) for r in runs]
    for s in one:
        assert three[s] <= one[s] + 1e-9 and abs(three[s] - again[s]) < 1e-6


def test_more_barycenter_steps(spark):
    model = cluster.fit_dtw_kmeans(shapes(spark, 12), clusters=3, seed=3, max_iter=2, barycenter_steps=3)
    assert model.count() == 6


def test_one_step_from_given_centers_equals_the_plain_method(spark):
    rng = np.random.default_rng(11)
    rows = [("N", s, "tmpf", f"2024-{1 + d // 28:02d}-{d % 28 + 1:02d}", rng.normal(size=6).tolist()) for s in "ab" for d in range(150)]
    df = spark.createDataFrame(rows, "network string, station string, column string, day string, values array<double>") \
        .withColumn("day", F.col("day").cast("timestamp_ntz"))
    start = {s: rng.normal(size=(3, 6)) for s in "ab"}
    given = spark.createDataFrame([("N", s, "tmpf", k, c.tolist()) for s, cs in start.items() for k, c in enumerate(cs)],
                                  "network string, station string, column string, cluster int, center array<double>")
    found = cluster.fit_dtw_kmeans(df.repartition(3), clusters=3, start=given, max_iter=1).collect()
    for s in "ab":
        series = [np.array(r[4]) for r in rows if r[1] == s]
        costs = np.array([[plain_dtw(x, c) ** 2 for c in start[s]] for x in series])
        sums, counts = np.zeros((3, 6)), np.zeros((3, 6))
        for x, k in zip(series, costs.argmin(axis=1)):
            dtw.path_sums(start[s][k][None, :], x[None, :], np.array([k]), sums, counts)
        mine = {r.cluster: r for r in found if r.station == s}
        assert np.allclose([mine[k].center for k in range(3)], sums / counts)
        assert np.isclose(mine[0].inertia, costs.min(axis=1).mean()) and mine[0].iterations == 1


def test_fewer_rows_than_clusters(spark):
    df = shapes(spark, 2)
    model = cluster.fit_dtw_kmeans(df, clusters=4, seed=0, max_iter=3)
    assert model.count() == 8
    assert cluster.assign_dtw(df, model).where("distance > 1e-9").count() == 0


def test_model_store(spark, tmp_path):
    df = shapes(spark, 12)
    path = str(tmp_path / "models")
    options = dict(clusters=3, seed=3, max_iter=2)
    first = table(cluster.stored_dtw_model(df.where("station = 'a'"), path, **options).select("station", "cluster", "center"), "cluster")
    both = cluster.stored_dtw_model(df, path, clusters=2, seed=9, max_iter=2)
    # The stored model stays; only the new station is fitted, here with two centers.
    assert table(both.where("station = 'a'").select("station", "cluster", "center"), "cluster") == first
    assert both.where("station = 'b'").count() == 2
    assert cluster.assign_dtw(df, both).count() == 24
    again = cluster.stored_dtw_model(df, path, refit=True, **options)
    assert again.count() == 6
    document = cluster.model_json(again, n_clusters=3, metric="dtw").first().document
    assert '"metric":"dtw"' in document and '"cluster_centers_":[[' in document


def test_euclidean_kmeans(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (np.array([10.0 * (i % 3), -5.0 * (i % 3)]) + rng.normal(size=2) * 0.1).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "i int, x array<double>")
    centers = cluster.fit_kmeans(df, "x", 3, seed=1)
    found = table(cluster.assign_kmeans(df, "x", centers).select("i", "cluster", "distance"), "i")
    assert len({c for _, c, _ in found}) == 3 and max(d for *_, d in found) < 1
    assert all(found[i][1] == found[i % 3][1] for i in range(90))
    with pytest.raises(ValueError):
        cluster.assign_kmeans(df, "x", centers.limit(0))


def test_labels_beside_each_other(spark):
    labels = spark.createDataFrame(
        [("N", "a", "tmpf", "2024-01-01", 1), ("N", "a", "feel", "2024-01-01", 2), ("N", "a", "feel", "2024-01-02", 0)],
        "network string, station string, column string, day string, cluster int")
    found = table(cluster.align_labels(labels, ["tmpf", "feel"]), "day")
    assert found == [("N", "a", "2024-01-01", 1, 2), ("N", "a", "2024-01-02", None, 0)]
