"""LOWESS (Cleveland 1979) on arrays of values, vectorised over the rows of an Arrow batch.

A row's x values are its slot numbers. Rows whose missing slots agree share their windows and weights, so
a batch is a few dense matrix products; smoothing adds no exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Defaults of the smoother, and the shares of the window radius inside which a point gets
# full weight and beyond which it gets none.
FRAC, PASSES, DELTA = 2.0 / 3.0, 3, 0.0
NEAR, FAR = 0.001, 0.999
# Residuals this small beside the row's largest value are rounding and count as zero; the robust weights would
# otherwise divide noise by noise.
_ROUNDING = 1e-10
# A residual on the edge of the robust weight has weight zero, not a weight made of rounding.
_EDGE = 1e-9


def _windows(x: np.ndarray, k: int) -> np.ndarray:
    """First index of the k nearest points of every x; x is sorted."""
    starts = np.zeros(len(x), dtype=np.int64)
    left = 0
    for i, at in enumerate(x):
        while left + k < len(x) and at > (x[left] + x[left + k]) / 2:
            left += 1
        starts[i] = left
    return starts


def _anchors(x: np.ndarray, delta: float) -> np.ndarray:
    """Points that are fitted; the ones between, within delta, are interpolated."""
    if delta <= 0:
        return np.arange(len(x))
    chosen = [0]
    while chosen[-1] < len(x) - 1:
        reach = int(np.searchsorted(x, x[chosen[-1]] + delta, side="right")) - 1
        chosen.append(max(chosen[-1] + 1, reach))
    return np.array(chosen)


def lowess_matrix(x: np.ndarray, y: np.ndarray, frac: float = FRAC, passes: int = PASSES,
                  delta: float = DELTA) -> np.ndarray:
    """Smooth the rows of ``y`` (rows x points) over the shared, sorted ``x``."""
    rows, n = y.shape
    k = min(n, int(frac * n + 1e-10))
    if n == 0 or rows == 0 or k < 1:
        return y.copy()
    starts = _windows(x, k)
    index = starts[:, None] + np.arange(k)[None, :]
    distance = np.abs(x[index] - x[:, None])
    radius = np.maximum(distance[:, 0], distance[:, -1])[:, None]
    share = np.divide(distance, radius, out=np.zeros_like(distance), where=radius > 0)
    tricube = np.where(share <= NEAR, 1.0, np.where(share > FAR, 0.0, (1 - share**3) ** 3))
    near_x = x[index]
    anchors = _anchors(x, delta)
    robust = np.ones_like(y)
    fit = y.copy()
    noise = _ROUNDING * np.abs(y).max(axis=1, keepdims=True)
    for turn in range(passes + 1):
        for i in anchors:
            w = tricube[i] * robust[:, index[i]]
            total = w.sum(axis=1)
            usable = total > 0
            safe = np.where(usable, total, 1.0)
            w = w / safe[:, None]
            ys = y[:, index[i]]
            mean_x = w @ near_x[i]
            mean_y = np.einsum("rk,rk->r", w, ys)
            off = near_x[i][None, :] - mean_x[:, None]
            square = np.einsum("rk,rk->r", w, off * off)
            cross = np.einsum("rk,rk->r", w, off * ys)
            slope = np.divide(cross, square, out=np.zeros_like(cross), where=square > 1e-12)
            fit[:, i] = np.where(usable, mean_y + slope * (x[i] - mean_x), y[:, i])
        if len(anchors) < n:
            for r in range(rows):
                fit[r] = np.interp(x, x[anchors], fit[r, anchors])
        if turn == passes:
            break
        residual = np.abs(y - fit)
        residual[residual <= noise] = 0.0
        scale = 6.0 * np.median(residual, axis=1)[:, None]
        ratio = np.divide(residual, scale, out=np.where(residual > 0, 1.0, 0.0), where=scale > 0)
        robust = np.where(ratio >= 1 - _EDGE, 0.0, (1 - np.minimum(ratio, 1.0) ** 2) ** 2)
    return fit


def _smooth_batch(values: pa.Array, frac: float, passes: int, delta: float) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    lengths = np.asarray(values.value_lengths().fill_null(0), dtype=np.int64)
    flat_array = values.flatten()
    flat = np.asarray(flat_array.to_numpy(zero_copy_only=False), dtype=np.float64)
    present = ~np.isnan(flat)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    out = flat.copy()
    # Rows of one length and one pattern of missing slots are smoothed together.
    groups: dict[tuple[int, bytes], list[int]] = {}
    for r, length in enumerate(lengths):
        mask = present[offsets[r]:offsets[r] + length]
        groups.setdefault((int(length), b"" if mask.all() else mask.tobytes()), []).append(r)
    for (length, pattern), members in groups.items():
        kept = np.frombuffer(pattern, dtype=bool).nonzero()[0] if pattern else np.arange(length)
        if len(kept) == 0:
            continue
        cells = offsets[np.array(members)][:, None] + kept[None, :]
        out[cells] = lowess_matrix(kept.astype(np.float64), flat[cells], frac, passes, delta)
    cells = pa.array(out, mask=~present)
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), cells, mask=values.is_null()) \
        if values.null_count else pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), cells)


def lowess(values: Column, frac: float = FRAC, passes: int = PASSES, delta: float = DELTA) -> Column:
    """Smoothed array; a missing slot stays missing and takes no part in the fit."""

    @F.arrow_udf("array<double>")
    def smooth(batch: pa.Array) -> pa.Array:
        return _smooth_batch(batch, frac, passes, delta)

    return smooth(values)


def smooth_rows(df: DataFrame, frac: float = FRAC, passes: int = PASSES, delta: float = DELTA,
                values: str = "values", into: str | None = None) -> DataFrame:
    """Smooth the array column in place, or into another column to keep both."""
    return df.withColumn(into or values, lowess(F.col(values), frac, passes, delta))
