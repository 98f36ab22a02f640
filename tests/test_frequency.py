"""Buckets of any width against pandas' own grouping, and their parsing."""

import numpy as np
import pandas as pd
import pytest

from gustline.functions.frequency import Frequency, frequency_of
from gustline.operators import fill, resample

SERIES = {
    "A": ["2024-01-10 23:10", "2024-01-11 04:59", "2024-01-31 14:00", "2024-02-29 00:00", "2024-05-05 12:30", "2025-01-01 00:00"],
    "B": ["2023-12-31 18:00", "2024-01-01 00:00", "2024-01-07 23:59:59", "2024-03-30 01:00"],
    "C": ["2024-02-04 00:00"],
}


def frame(spark):
    rows = [(k, t, float(i * i + 1)) for k, times in SERIES.items() for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "station string, valid string, v double").selectExpr(
        "'N' as network", "station", "cast(valid as timestamp_ntz) as valid", "v", "v as w", "v as x")


def by_pandas(key: str, frequency: str) -> pd.DataFrame:
    times = pd.to_datetime(SERIES[key], format="mixed")
    values = pd.Series([float(i * i + 1) for i in range(len(times))], index=times)
    mean = values.groupby(pd.Grouper(freq=frequency)).mean()
    return pd.DataFrame({"v": mean.interpolate(method="time", limit_direction="both"), "w": mean.ffill().bfill(), "x": mean})


@pytest.mark.parametrize("ours, theirs", [
    ("5h", "5h"), ("7h", "7h"), ("2D", "2D"), ("5D", "5D"), ("1h", "1h"), ("100min", "100min"), ("W", "W"), ("2W", "2W"), ("3W", "3W"),
    ("M", "ME"), ("2M", "2ME"), ("MS", "MS"), ("5MS", "5MS"), ("Q", "QE"), ("2QE", "2QE"), ("QS", "QS"), ("2QS", "2QS"),
    ("Y", "YE"), ("YS", "YS"), ("2YS", "2YS")])
def test_as_pandas_groups(spark, ours, theirs):
    got = fill.resample_filled(frame(spark), {c: "mean" for c in "vwx"}, {"v": "linear", "w": "ffill_bfill"}, ours).toPandas()
    sparse = resample.resample(frame(spark), {"v": "mean"}, ours, dense=False).toPandas()
    for key in SERIES:
        want = by_pandas(key, theirs)
        mine = got[got.station == key].sort_values("valid").set_index("valid")
        assert list(mine.index) == list(want.index), key
        for c in "vwx":
            assert np.allclose(mine[c], want[c], equal_nan=True), (key, c)
        assert sorted(sparse[sparse.station == key].valid) == list(want.index[want.x.notna()])


def test_many_gaps_between_few_buckets(spark):
    """Longer than a chunk of buckets, so neighbours are carried over several."""
    df = spark.createDataFrame([("N", "S", "2000-01-01 03:00", 0.0), ("N", "S", "2024-01-01 00:00", 24.0)],
                               "network string, station string, valid string, v double").selectExpr(
        "network", "station", "cast(valid as timestamp_ntz) as valid", "v")
    got = fill.resample_filled(df, {"v": "mean"}, {"v": "linear"}, "7h").toPandas().sort_values("valid")
    want = pd.Series([0.0, 24.0], index=pd.to_datetime(["2000-01-01 03:00", "2024-01-01 00:00"])).groupby(
        pd.Grouper(freq="7h")).mean().interpolate(method="time")
    assert len(got) == len(want) > 3 * resample.CHUNK_BUCKETS and list(got.valid) == list(want.index)
    assert np.allclose(got.v, want)


def test_medians_of_anchored_buckets(spark):
    df = frame(spark).selectExpr("network", "station", "valid", "v as skyl1").where("skyl1 is not null")
    got = resample.resample(df.union(df), {"skyl1": "median"}, "30D", dense=False).toPandas()
    for key in SERIES:
        times = pd.to_datetime(SERIES[key], format="mixed")
        want = pd.Series([float(i * i + 1) for i in range(len(times))], index=times).groupby(pd.Grouper(freq="30D")).median().dropna()
        mine = got[got.station == key].sort_values("valid")
        assert list(mine.valid) == list(want.index) and np.allclose(mine.skyl1, want)


@pytest.mark.parametrize("text, want", [
    ("5h", Frequency("fixed", 18_000)), (90, Frequency("fixed", 90)), ("2M", Frequency("month", 1, 2, True)),
    ("1 month", Frequency("month", 1)), ("3 weeks", Frequency("week", 1, 3)), ("QS", Frequency("month", 3)), ("min", Frequency("fixed", 60))])
def test_parsing(text, want):
    assert frequency_of(text) == want


@pytest.mark.parametrize("text", ["", "0M", "M2", "fortnight", "-1 month", 0])
def test_unknown(text):
    with pytest.raises(ValueError):
        frequency_of(text)
