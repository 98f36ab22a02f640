"""Versions of a table: failed writes, two writers, readers in between."""

import threading

import pytest
from dataclasses import replace

from gustline import versions
from gustline.operators import scale
from gustline.sources import sinks, tables


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def values(df):
    return sorted(r.v for r in df.collect())


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read(spark, path) is None and versions.current(spark, path).number == 0
    versions.append(spark, path, "x", lambda old: rows(spark, 1))
    versions.append(spark, path, "x", lambda old: rows(spark, 2))
    before = versions.read(spark, path)
    assert versions.append(spark, path, "x", lambda old: None).count() == 2
    versions.append(spark, path, "x", lambda old: rows(spark, *[v * 10 for v in values(old)]), instead=True)
    versions.append(spark, path, "y", lambda old: rows(spark, 5))
    # The reader stays with the version it began with.
    assert values(before) == [1, 2] and values(versions.read(spark, path, ["x"])) == [10, 20] and values(versions.read(spark, path)) == [5, 10, 20]
    assert versions.current(spark, path).number == 4


def test_a_write_that_fails_midway_changes_nothing(spark, obs, tmp_path):
    path = str(tmp_path / "t")
    versions.append(spark, path, "x", lambda old: rows(spark, 1))
    with pytest.raises(Exception):
        versions.append(spark, path, "x", lambda old: rows(spark, 1, 0).selectExpr("assert_true(v > 0) is null as w", "v"))
    assert values(versions.read(spark, path)) == [1]
    store = str(tmp_path / "o")
    sinks.write_observations(obs([("a", "2024-01-01 00:00", 1.0)], ["tmpf"]), store)
    with pytest.raises(Exception):
        sinks.write_observations(obs([("a", "2024-01-01 00:00", 2.0)], ["tmpf"]).selectExpr(
            "network", "station", "valid", "if(tmpf > 1, raise_error('lost'), tmpf) as tmpf"), store)
    assert [r.tmpf for r in tables.read_stored(spark, store).collect()] == [1.0]


def test_second_writer_starts_again(spark, tmp_path):
    path = str(tmp_path / "t")
    calls = []

    def late(old):
        calls.append(None if old is None else values(old))
        if len(calls) == 1:
            # Another writer comes first.
            versions.append(spark, path, "x", lambda o: rows(spark, 1))
        return rows(spark, 2)

    assert values(versions.append(spark, path, "x", late)) == [1, 2]
    assert calls == [None, [1]]


def test_many_writers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    threads = [threading.Thread(target=versions.append, args=(spark, path, "x", lambda old, i=i: rows(spark, i))) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert values(versions.read(spark, path)) == list(range(6)) and versions.current(spark, path).number == 6


def test_gives_up_after_some_attempts(spark, tmp_path):
    path = str(tmp_path / "t")

    def always_late(base):
        versions.append(spark, path, "x", lambda o: rows(spark, 1))
        return replace(base, folders={})

    with pytest.raises(RuntimeError):
        versions.change(spark, path, always_late, attempts=2)


def test_two_fits_of_one_store(spark, obs, tmp_path):
    path = str(tmp_path / "s")
    df = obs([(s, "2024-01-01 00:00", v) for s in "ab" for v in (0.0, 4.0)], ["tmpf"])
    only = df.where("station = 'a'")
    held = scale.stored_scaler(only, path, "minmax")
    both = scale.stored_scaler(df, path, "minmax")
    assert held.count() == 1 and both.count() == 2
    wider = df.withColumn("tmpf", df.tmpf * 2)
    again = scale.stored_scaler(wider.where("station = 'b'"), path, "minmax", refit=True)
    assert {r.station: r.scale for r in again.collect()} == {"a": 4.0, "b": 8.0}
    # What was read before the refit still is what it was.
    assert {r.station: r.scale for r in both.collect()} == {"a": 4.0, "b": 4.0}
