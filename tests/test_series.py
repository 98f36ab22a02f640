"""Dedup, resampling, filling and the whole clean, on hand-worked inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import table
from gustline.functions import encode, timeline
from gustline.operators import dedup, fill, neighbours, resample
from gustline.operators import quantiles as Q
from gustline.operators.neighbours import with_neighbours
from gustline.plans.clean import clean


def hours(df, column="tmpf"):
    return [r[column] for r in df.orderBy("station", "valid").collect()]


def test_dedup_keeps_the_last_of_the_most_complete(obs):
    df = obs([("a", "2024-01-01 00:00", 0, 1.0, 2.0), ("a", "2024-01-01 00:00", 1, 3.0, 4.0),
              ("a", "2024-01-01 00:00", 2, 5.0, None), ("b", "2024-01-01 00:00", 3, None, None)],
             ["src_seq bigint", "tmpf", "dwpf"])
    assert [(r.station, r.src_seq) for r in dedup.dedup_best(df).orderBy("station").collect()] == [("a", 1), ("b", 3)]


def test_dedup_limits_rows_before_the_exchange(obs):
    df = obs([("a", "2024-01-01 00:00", i, float(i)) for i in range(100)], ["src_seq bigint", "tmpf"])
    plan = dedup.dedup_best(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


GRID = [("a", "2024-01-01 13:20", 1.0), ("a", "2024-01-01 13:50", 3.0), ("a", "2024-01-01 16:10", None),
        ("a", "2024-01-03 02:00", 10.0)]


def test_dense_grid_runs_from_first_to_last_hour(obs):
    found = hours(resample.resample(obs(GRID, ["tmpf"]), {"tmpf": "mean"}))
    assert len(found) == 38 and found[0] == 2.0 and found[-1] == 10.0 and found[1:37] == [None] * 36


def test_grid_is_per_station_and_survives_small_chunks(obs, monkeypatch):
    monkeypatch.setattr(resample, "CHUNK_BUCKETS", 5)
    rows = GRID + [("b", "2024-01-01 00:00", 1.0), ("b", "2024-01-01 11:00", 2.0)]
    found = resample.resample(obs(rows, ["tmpf"]), {"tmpf": "mean"})
    assert {r["station"]: r["count"] for r in found.groupBy("station").count().collect()} == {"a": 38, "b": 12}
    assert found.select("station", "valid").distinct().count() == 50


def test_times_before_1970(obs):
    rows = [("a", "1969-12-31 22:30", 1.0), ("a", "1970-01-01 01:30", 4.0)]
    found = table(clean(obs(rows, ["tmpf"])).select("valid", "tmpf"), "valid")
    assert found == [(dt.datetime(1969, 12, 31, 22), 1.0), (dt.datetime(1969, 12, 31, 23), 2.0),
                     (dt.datetime(1970, 1, 1, 0), 3.0), (dt.datetime(1970, 1, 1, 1), 4.0)]


@pytest.mark.parametrize("method, expected", [
    ("linear", [1.0, 1.0, 2.0, 3.0, 3.0]), ("ffill", [None, 1.0, 1.0, 3.0, 3.0]),
    ("ffill_bfill", [1.0, 1.0, 1.0, 3.0, 3.0]), ("zero", [0.0, 1.0, 0.0, 3.0, 0.0])])
@pytest.mark.parametrize("days", [64, 1])
def test_fill_methods(obs, method, expected, days):
    rows = [("a", f"2024-01-0{i + 1} 12:00", v) for i, v in enumerate([None, 1.0, None, 3.0, None])]
    assert hours(fill.fill_gaps(obs(rows, ["tmpf"]), {"tmpf": method}, chunk_days=days)) == expected


def test_what_a_task_sorts_is_bounded(obs, monkeypatch):
    rows = [(s, f"2024-01-{d:02d} {h:02d}:10", float(h) if h % 3 else None) for s in "ab" for d in range(1, 29) for h in range(0, 24, 5)]

    def found():
        return fill.resample_filled(obs(rows, ["tmpf"]), {"tmpf": "mean"}, {"tmpf": "linear"})

    want = table(found(), "station", "valid")
    monkeypatch.setattr(neighbours, "TASK_ROWS", 20)
    plan = found()._jdf.queryExecution().executedPlan().toString()
    # 280 buckets, 20 a task; no hash table of the chunks, and the windows are below the join.
    assert ", 14), REPARTITION_BY_NUM" in plan and "ShuffledHashJoin" not in plan and "SortMergeJoin" in plan
    assert table(found(), "station", "valid") == want


@pytest.mark.parametrize("method", ["linear", "ffill", "ffill_bfill", "zero"])
def test_filling_buckets_equals_filling_the_dense_series(obs, method):
    rng = random.Random(5)
    rows = [(s, f"2024-01-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}",
             rng.choice([None, rng.random()])) for s in "abc" for _ in range(60)]
    df = obs([*rows, ("d", "2024-01-01 00:00", None), ("d", "2024-01-02 00:00", None)], ["tmpf"])
    rules = {"tmpf": "mean"}
    dense = table(fill.fill_gaps(resample.resample(df, rules), {"tmpf": method}), "station", "valid")
    found = table(fill.resample_filled(df, rules, {"tmpf": method}), "station", "valid")
    assert [r[:3] for r in found] == [r[:3] for r in dense]
    assert all(a == b if a is None or b is None else abs(a - b) < 1e-12 for (*_, a), (*_, b) in zip(found, dense))


def test_fill_does_not_leak_between_stations(obs):
    rows = [("a", "2024-01-01 00:00", 1.0), ("b", "2024-01-01 01:00", None), ("b", "2024-01-01 02:00", 7.0)]
    assert hours(fill.fill_gaps(obs(rows, ["tmpf"]), {"tmpf": "ffill"})) == [1.0, None, 7.0]


def test_neighbours_equal_a_plain_scan(obs, spark):
    rng = random.Random(3)
    series = [(s, p, rng.choice([None, rng.random()])) for s in "ab" for p in sorted(rng.sample(range(200), 60))]
    df = spark.createDataFrame(series, "k string, p bigint, v double")
    found = {(r.k, r.p): r for r in with_neighbours(df, "p", ["v"], ["k"], 7).collect()}
    for k, p, _ in series:
        mine = [(q, v) for s, q, v in series if s == k]
        before = [x for x in mine if x[0] <= p and x[1] is not None]
        after = [x for x in mine if x[0] > p and x[1] is not None]
        later = [q for q, _ in mine if q > p]
        r = found[(k, p)]
        assert tuple(r["__before_v"] or ()) == (before[-1] if before else ())
        assert tuple(r["__after_v"] or ()) == (after[0] if after else ())
        assert r["__next_position"] == (later[0] if later else None)
        assert r["__first_position"] == mine[0][0]


def test_code_medians_and_the_integer_check(obs):
    rows = [("a", "2024-01-01 00:00", "CLR"), ("a", "2024-01-01 00:30", "FEW"), ("a", "2024-01-01 01:00", "VV "),
            ("a", "2024-01-01 02:00", "???"), ("a", "2024-01-01 03:00", None)]
    df = obs(rows, ["skyc1 string"])
    ranks = df.select("network", "station", "valid", encode.ordinal_code(F.col("skyc1")).alias("skyc1"))
    assert hours(resample.resample(ranks), "skyc1") == [0.5, 5.0, None, None]
    # The half is voided and takes the next whole code, as there is none before it.
    assert hours(clean(df), "skyc1") == [5.0] * 4


def test_whole_code(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (5.0,), (6.0,), (None,)], "x double")
    assert [r[0] for r in df.select(encode.whole_code(F.col("x"))).collect()] == [0.0, None, 5.0, None, None]


def test_indicators(obs):
    rows = [("a", "2024-01-01 00:00", 0.2, None), ("a", "2024-01-01 00:30", None, None), ("a", "2024-01-01 01:00", None, None),
            ("a", "2024-01-01 03:00", 0.0, None), ("b", "2024-01-01 00:00", None, 5.0)]
    found = table(clean(obs(rows, ["p01i", "gust"]), main=False).select("station", "p01i", "gust"), "station", "valid")
    # No report in hour two; a station that never reports a measurement has no indicator.
    assert found == [("a", 1.0, None), ("a", 0.0, None), ("a", 0.0, None), ("a", 0.0, None), ("b", None, 1.0)]


def test_direction_becomes_sine_and_cosine(obs):
    found = clean(obs([("a", "2024-01-01 00:00", 90.0), ("a", "2024-01-01 02:00", 180.0)], ["drct"]), main=False)
    assert found.columns == ["network", "station", "valid", "drct_sin", "drct_cos"]
    assert [(round(r.drct_sin, 9), round(r.drct_cos, 9)) for r in found.orderBy("valid").collect()] == [(1, 0), (1, 0), (0, -1)]


def test_not_a_number_is_missing(obs):
    rows = [("a", "2024-01-01 00:00", 1.0), ("a", "2024-01-01 01:00", float("nan")), ("a", "2024-01-01 02:00", 3.0)]
    assert hours(clean(obs(rows, ["tmpf"]))) == [1.0, 2.0, 3.0]


def test_clean_keeps_only_known_columns(obs):
    df = obs([("a", "2024-01-01 00:00", 1.0, 2.0, "x")], ["tmpf", "mslp", "wxcodes string"])
    assert clean(df).columns == ["network", "station", "valid", "tmpf"]


def test_clean_does_not_depend_on_partitions_or_zone(spark, obs):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), f"2024-03-{rng.randint(1, 31):02d} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}",
             rng.choice([None, rng.random()]), rng.choice([None, float(rng.randint(0, 40) * 100)])) for _ in range(300)]
    results = []
    for partitions, zone in (("8", "UTC"), ("1", "America/New_York"), ("3", "Europe/Athens")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.session.timeZone", zone)
        results.append(table(clean(obs(rows, ["tmpf", "skyl1"])).selectExpr(
            "station", "cast(valid as string)", "round(tmpf, 9)", "skyl1"), "station", "valid"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1] == results[2]


def test_one_scan_and_one_exchange_per_key(spark, obs, tmp_path):
    obs([(s, f"2024-01-0{d} 00:00", float(d), 1.0) for s in "ab" for d in range(1, 9)], ["tmpf", "skyl1"]).write.parquet(
        str(tmp_path / "o"))
    df = clean(spark.read.parquet(str(tmp_path / "o")))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("ReusedExchange") == 1


def test_busy_bucket_gets_its_exact_median(spark, monkeypatch):
    monkeypatch.setattr(resample, "SMALL_GROUP", 50)
    monkeypatch.setattr(Q, "ACCURACY", 100)
    rng = random.Random(5)
    values = [round(rng.gauss(100, 30), 3) for _ in range(4001)]
    rows = [("N", "hot", v) for v in values] + [("N", "cold", 1.0), ("N", "cold", 2.0)]
    df = spark.createDataFrame(rows, "network string, station string, drct double").withColumn(
        "valid", F.expr("timestamp_ntz'2024-01-01 00:10:00'"))
    found = {r.station: r.drct for r in resample.resample(df, {"drct": "median"}).collect()}
    assert found == {"hot": sorted(values)[2000], "cold": 1.5}


@pytest.mark.parametrize("text, seconds", [("1 hour", 3600), ("H", 3600), ("30min", 1800), ("2 days", 172800), ("15 minutes", 900), (60, 60)])
def test_step_seconds(text, seconds):
    assert timeline.step_seconds(text) == seconds


@pytest.mark.parametrize("text", ["1 month", "", "hourly", "-1 hour", 0])
def test_unknown_steps(text):
    with pytest.raises(ValueError):
        timeline.step_seconds(text)
