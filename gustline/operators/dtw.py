"""Dynamic time warping over Arrow batches.

Distance: square root of the summed squared differences along the cheapest path. All pairs of a batch move
through the cost matrix together, one cell at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Series that are aligned together; bounds the cost tables.
SLICE = 4096


def as_matrix(values: pa.Array) -> np.ndarray:
    """Lists of one length to a rows x points matrix."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    flat = np.asarray(values.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(len(values), -1) if len(values) else flat.reshape(0, 0)


def squared_costs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared DTW distance of the matching rows of ``a`` and ``b`` (pairs x points each)."""
    pairs, n = a.shape
    m = b.shape[1]
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    line = np.empty((m, pairs))
    for i in range(n):
        diagonal = None
        for j in range(m):
            cost = a[i] - b[j]
            cost *= cost
            above = line[j].copy() if i else None
            if i and j:
                cost += np.minimum(np.minimum(above, diagonal), line[j - 1])
            elif i:
                cost += above
            elif j:
                cost += line[j - 1]
            line[j] = cost
            diagonal = above
    return line[m - 1].copy()


def path_sums(center: np.ndarray, rows: np.ndarray, target: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Align each row with its center and add its values to the center positions they meet.

    ``target`` names, per row, the line of ``sums`` and ``counts`` to add to.
    """
    pairs, n = center.shape
    m = rows.shape[1]
    table = np.full((n + 1, m + 1, pairs), np.inf)
    table[0, 0] = 0.0
    for i in range(n):
        for j in range(m):
            step = (center[:, i] - rows[:, j]) ** 2
            table[i + 1, j + 1] = step + np.minimum(np.minimum(table[i, j], table[i, j + 1]), table[i + 1, j])
    at_i, at_j = np.full(pairs, n), np.full(pairs, m)
    live = np.arange(pairs)
    while len(live):
        i, j = at_i[live], at_j[live]
        np.add.at(sums, (target[live], i - 1), rows[live, j - 1])
        np.add.at(counts, (target[live], i - 1), 1.0)
        moves = np.stack([table[i - 1, j - 1, live], table[i - 1, j, live], table[i, j - 1, live]])
        best = moves.argmin(axis=0)
        at_i[live] = i - (best != 2)
        at_j[live] = j - (best != 1)
        live = live[(at_i[live] > 0) & (at_j[live] > 0)]


def as_series(blocks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of lists of one length: the matrix of all inner lists, the outer list of each, where each outer list starts."""
    if isinstance(blocks, pa.ChunkedArray):
        blocks = blocks.combine_chunks()
    sizes = np.asarray(blocks.value_lengths().fill_null(0), dtype=np.int64)
    return as_matrix(blocks.flatten()), np.repeat(np.arange(len(sizes)), sizes), np.concatenate([[0], np.cumsum(sizes)])


def nearest_center(rows: np.ndarray, centers: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest center, the first on a tie; row i is held against ``centers[owner[i]]``."""
    label, least = np.zeros(len(rows), dtype=np.int64), np.full(len(rows), np.inf)
    for begin in range(0, len(rows), SLICE):
        part = slice(begin, begin + SLICE)
        for c in range(centers.shape[1]):
            cost = squared_costs(rows[part], centers[owner[part], c])
            nearer = cost < least[part]
            label[part][nearer], least[part][nearer] = c, cost[nearer]
    return label, least


def dtw_distance(a: Column, b: Column) -> Column:
    """DTW distance of two array columns."""

    @F.arrow_udf("double")
    def distance(x: pa.Array, y: pa.Array) -> pa.Array:
        if isinstance(x, pa.ChunkedArray):
            x, y = x.combine_chunks(), y.combine_chunks()
        width = np.asarray(x.value_lengths().fill_null(0))
        height = np.asarray(y.value_lengths().fill_null(0))
        result = np.full(len(x), np.nan)
        shapes = np.stack([width, height], axis=1)
        for shape in np.unique(shapes, axis=0) if len(x) else []:
            if shape.min() == 0:
                continue
            rows = np.nonzero((shapes == shape).all(axis=1))[0]
            take = pa.array(rows)
            result[rows] = np.sqrt(squared_costs(as_matrix(x.take(take)), as_matrix(y.take(take))))
        return pa.array(result, mask=np.isnan(result))

    return distance(a, b)


def dtw_labels(blocks: Column, centers: Column) -> Column:
    """Per series of a block: struct (cluster, distance) of the nearest center; ``centers`` holds them one after the other."""

    @F.arrow_udf("array<struct<cluster:int,distance:double>>")
    def labels(series: pa.Array, flat: pa.Array) -> pa.Array:
        if isinstance(series, pa.ChunkedArray):
            series, flat = series.combine_chunks(), flat.combine_chunks()
        x, owner, starts = as_series(series)
        found, cost = np.zeros(len(x), dtype=np.int32), np.zeros(len(x))
        sizes = np.asarray(flat.value_lengths())
        # Groups may have models with different numbers of centers.
        for size in np.unique(sizes) if len(x) else []:
            members = np.flatnonzero(sizes == size)
            mine = np.flatnonzero(sizes[owner] == size)
            own = as_matrix(flat.take(pa.array(members))).reshape(len(members), -1, x.shape[1])
            found[mine], cost[mine] = nearest_center(x[mine], own, np.searchsorted(members, owner[mine]))
        near = pa.StructArray.from_arrays([pa.array(found), pa.array(np.sqrt(cost))], names=["cluster", "distance"])
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), near)

    return labels(blocks, centers)
