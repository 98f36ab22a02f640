"""LOWESS of long columns against the form for rows."""

import numpy as np
import pytest

from gustline.operators.smooth import lowess_matrix
from gustline.operators.smooth_long import smooth_column


def series(rng, n, missing=0.0):
    y = np.sin(np.arange(n) / 9.0) * 5 + rng.normal(size=n)
    y[rng.random(n) < 0.03] += 40
    return [None if rng.random() < missing else float(v) for v in y]


def frame(spark, found):
    rows = [(k, i * 3, v) for k, values in found.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "station string, at bigint, v double").repartition(5)


def want(values, **options):
    x = np.array([i for i, v in enumerate(values) if v is not None], float)
    y = np.array([[v for v in values if v is not None]], float)
    out = iter(lowess_matrix(x, y, **options)[0].tolist())
    return [None if v is None else next(out) for v in values]


@pytest.mark.parametrize("options, missing", [
    ({"frac": 0.2}, 0.0), ({"frac": 0.2}, 0.3), ({"frac": 0.5, "delta": 6.5}, 0.0), ({"frac": 0.3, "delta": 5.0, "passes": 1}, 0.3),
    ({"frac": 1.0, "passes": 0}, 0.1), ({}, 0.0), ({"frac": 0.2, "delta": 1000.0}, 0.2)])
def test_as_rows(spark, options, missing):
    """Chunks and blocks far shorter than a window, so sums come from many of them."""
    rng = np.random.default_rng(1)
    found = {"a": series(rng, 150, missing), "b": series(rng, 37, missing), "c": [1.0], "d": [2.0, 5.0], "e": [None, 3.0, None]}
    got = smooth_column(frame(spark, found), "v", ["station"], ["at"], chunk=16, block=8, **options)
    assert got.columns == ["station", "at", "v", "v_smooth"]
    rows = {k: [r.v_smooth for r in sorted(got.where(f"station = '{k}'").collect(), key=lambda r: r["at"])] for k in found}
    for k, values in found.items():
        expected = want(values, **options)
        assert [v is None for v in rows[k]] == [v is None for v in expected]
        assert np.allclose([v for v in rows[k] if v is not None], [v for v in expected if v is not None], atol=1e-8), k


def test_no_task_gathers_a_series(spark):
    """Packed rows are bounded by chunk and block, whatever the length of the series."""
    from gustline.operators import smooth_long as S
    from gustline.operators.running import with_row_numbers
    from pyspark.sql import functions as F
    n = 3000
    points = with_row_numbers(spark.range(n).selectExpr("'s' as station", "id as __x"), ["__x"], ["station"], "__rank") \
        .withColumn("__n", F.lit(n).cast("bigint")).withColumn("__k", F.lit(500).cast("bigint"))
    blocks = S._blocks(S._windows(points, S._anchors(points, ["station"], 0.0), ["station"]), ["station"], 64, 32)
    sizes = blocks.select(F.size("at").alias("n"), "block", "chunk").collect()
    assert max(r.n for r in sizes) <= 32 and len({r.block for r in sizes}) == -(-n // 32)
    assert max(sum(1 for r in sizes if r.block == b) for b in {r.block for r in sizes}) <= (500 + 32) // 64 + 2


def test_no_rows(spark):
    assert smooth_column(frame(spark, {}), "v", ["station"], ["at"]).count() == 0
    assert [r.v_smooth for r in smooth_column(frame(spark, {"a": [None, None]}), "v", ["station"], ["at"]).collect()] == [None, None]
