"""K-means: Euclidean over feature arrays, and DTW with barycenter averaging per group of series.

The DTW fit trains every group (station and column) at once. The state is one row per group; rows stay
distributed, in blocks of days that meet their group's centers once, and each step sends only per-batch sums to one
small aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline import versions
from gustline.functions.timeline import epoch_micros
from gustline.operators.dtw import SLICE, as_matrix, as_series, dtw_labels, nearest_center, path_sums
from gustline.schema import KEYS
from gustline.storage import materialize

GROUP = (*KEYS, "column")
# Iteration cap and tolerance of a fit.
MAX_ITER, TOLERANCE = 50, 1e-6
# Rows of one group and this many days are handled together.
BLOCK_DAYS = 64
# Values of the centers that one pass over the rows holds; more centers take more passes in the same task.
_CENTER_VALUES = 4_000_000


# --- Euclidean ---------------------------------------------------------------------------------------

def fit_kmeans(df: DataFrame, features: str, clusters: int = 8, seed: int = 0, max_iter: int = 300,
               tolerance: float = 1e-4) -> DataFrame:
    """Centers table ``(cluster, center)`` from Spark's k-means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    vectors = df.select(array_to_vector(F.col(features)).alias("features"))
    model = KMeans(k=clusters, seed=seed, maxIter=max_iter, tol=tolerance).fit(vectors)
    centers = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(centers, "cluster int, center array<double>")


def assign_kmeans(df: DataFrame, features: str, centers: DataFrame) -> DataFrame:
    """Add ``cluster`` and ``distance`` of the nearest center, the lowest number on a tie."""
    found = sorted(centers.select("cluster", "center").collect())
    if not found:
        raise ValueError("no centers")
    kind = "struct<cluster:int,cost:double>"
    near = df.withColumn("__near", F.lit(None).cast(kind))
    step = max(1, _CENTER_VALUES // max(1, len(found[0]["center"])))
    for begin in range(0, len(found), step):
        near = near.withColumn("__near", _nearer(found[begin:begin + step], kind)(F.col(features), F.col("__near")))
    return near.select(*df.columns, F.col("__near.cluster").alias("cluster"), F.sqrt("__near.cost").alias("distance"))


def _nearer(block: list, kind: str):
    """The nearest of a block of centers, unless what is known is as near; earlier blocks have the lower numbers."""
    labels = np.array([r["cluster"] for r in block], dtype=np.int32)
    matrix = np.array([r["center"] for r in block], dtype=np.float64)

    @F.arrow_udf(kind)
    def nearest(rows: pa.Array, known: pa.Array) -> pa.Array:
        x = as_matrix(rows)
        cost = np.stack([((x - c) ** 2).sum(axis=1) for c in matrix], axis=1) if len(x) else np.empty((0, len(matrix)))
        best = cost.argmin(axis=1)
        label, least = labels[best], cost[np.arange(len(x)), best]
        before = known.field("cost").to_numpy(zero_copy_only=False).astype(float) if known.null_count < len(known) else np.full(len(x), np.inf)
        if len(x) and np.isfinite(before).any():
            keep = before <= least
            label = np.where(keep, known.field("cluster").to_numpy(zero_copy_only=False), label).astype(np.int32)
            least = np.where(keep, before, least)
        return pa.StructArray.from_arrays([pa.array(label), pa.array(least)], names=["cluster", "cost"])

    return nearest


# --- DTW ---------------------------------------------------------------------------------------------

def _stretch() -> Column:
    return F.floor(epoch_micros(F.col("day")) / F.lit(BLOCK_DAYS * 86_400_000_000))


def _blocks(df: DataFrame, group: Sequence[str], seed: int) -> DataFrame:
    """The series of one group and stretch of days in one row, each with a hash, so that centers travel once a block."""
    rows = df.where(~F.exists("values", lambda v: v.isNull())).select(
        *group, _stretch().alias("__block"), "day", F.col("values").cast("array<double>").alias("values"),
        F.xxhash64(F.lit(seed), *[F.col(g) for g in group], F.col("day").cast("string")).alias("h"))
    listed = rows.groupBy(*group, "__block").agg(F.sort_array(F.collect_list(F.struct("day", "h", "values"))).alias("s"))
    return listed.select(*group, F.col("s.values").alias("values"), F.col("s.h").alias("h"))


def _lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, type=pa.int32()), pa.array(matrix.ravel()))


def _codes(batch: pa.RecordBatch, group: Sequence[str]) -> np.ndarray:
    """Group number of every row of the batch."""
    parts = [pc.fill_null(pc.cast(batch.column(g), pa.string()), "\x00") for g in group]
    joined = pc.binary_join_element_wise(*parts, "\x1f") if len(parts) > 1 else parts[0]
    return np.asarray(joined.dictionary_encode().indices)


def _group_fields(df: DataFrame, group: Sequence[str]) -> list[T.StructField]:
    return [df.schema[g] for g in group]


def _waits(h: np.ndarray, turn: int) -> np.ndarray:
    """-log(u) with u from the row's hash and the turn (64-bit finalizer of a multiplicative hash)."""
    z = h.view(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return -np.log(((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54)


def _draw(blocks: DataFrame, newest: DataFrame | None, group: Sequence[str], turn: int) -> DataFrame:
    """K-means++ draw: each block's candidate (``wait``, ``pick``), beside the blocks with their least distances ``near``.

    Every row gets a waiting time -log(u) / distance² with u from its hash; the shortest wins, so the draw is an
    aggregate and does not depend on partitioning. ``near`` is carried on: only the newest center is aligned.
    """
    width = len(group)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, owner, starts = as_series(batch.column(width))
            wait = _waits(np.asarray(batch.column(width + 1).flatten()), turn)
            near = np.full(len(x), np.inf)
            if turn:
                before = batch.column(width + 2).flatten()
                if len(before):
                    near = np.asarray(before)
                near = np.minimum(near, nearest_center(x, as_matrix(batch.column(width + 3))[:, None, :], owner)[1])
                # Rows that coincide with a center come last, in hash order.
                wait = np.where(near > 0, wait / np.where(near > 0, near, 1.0), 1e300 * (1 + wait / 100))
            order = np.lexsort((wait, owner))
            winners = order[np.unique(owner[order], return_index=True)[1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(width + 2)] + [
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(near)), pa.array(wait[winners]), _lists(x[winners])],
                names=[*group, "values", "h", "near", "wait", "pick"])

    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType(_group_fields(blocks, group) + [
        blocks.schema["values"], blocks.schema["h"], T.StructField("near", doubles),
        T.StructField("wait", T.DoubleType()), T.StructField("pick", doubles)])
    if newest is None:
        return blocks.select(*group, "values", "h").mapInArrow(best, schema)
    known = blocks.select(*group, "values", "h", "near").join(newest, list(group))
    return known.select(*group, "values", "h", "near", "picked").mapInArrow(best, schema)


def _seed_centers(blocks: DataFrame, group: Sequence[str], clusters: int) -> DataFrame:
    state, newest = None, None
    for turn in range(clusters):
        if turn == 1:
            blocks = blocks.withColumn("near", F.array().cast("array<double>"))
        drawn = _draw(blocks, newest, group, turn)
        if 0 < turn < clusters - 1:
            blocks = drawn = materialize(drawn, "drawn")
        newest = materialize(drawn.groupBy(*group).agg(F.min_by("pick", "wait").alias("picked")), "picked")
        state = newest.withColumnRenamed("picked", "centers") if state is None else state.join(newest, list(group)).select(
            *group, F.concat("centers", "picked").alias("centers"))
    return state


def _partials(blocks: DataFrame, state: DataFrame, group: Sequence[str], clusters: int, labelled: bool) -> DataFrame:
    """Per batch, group and cluster: squared distances and rows, then aligned sums and counts; the farthest row."""
    width = len(group)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, owner, _ = as_series(batch.column(width))
            centers = as_matrix(batch.column(width + 1)).reshape(batch.num_rows, clusters, -1)
            if labelled:
                label, cost = np.asarray(batch.column(width + 2).flatten(), dtype=np.int64), np.zeros(len(x))
            else:
                label, cost = nearest_center(x, centers, owner)
            _, first, target = np.unique(_codes(batch, group)[owner] * clusters + label, return_index=True, return_inverse=True)
            points = centers.shape[2]
            total, count = np.zeros((len(first), points + 1)), np.zeros((len(first), points + 1))
            total[:, 0], count[:, 0] = np.bincount(target, weights=cost), np.bincount(target)
            for begin in range(0, len(x), SLICE):
                part = slice(begin, begin + SLICE)
                path_sums(centers[owner[part], label[part]], x[part], target[part], total[:, 1:], count[:, 1:])
            order = np.lexsort((-cost, target))
            far = order[np.unique(target[order], return_index=True)[1]]
            take = pa.array(owner[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(take) for i in range(width)] + [
                    pa.array(label[first].astype(np.int32)), _lists(total), _lists(count), pa.array(cost[far]), _lists(x[far])],
                names=[*group, "cluster", "total", "count", "far", "far_values"])

    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType(_group_fields(blocks, group) + [
        T.StructField("cluster", T.IntegerType()), T.StructField("total", doubles), T.StructField("count", doubles),
        T.StructField("far", T.DoubleType()), T.StructField("far_values", doubles)])
    extra = ["label"] if labelled else []
    joined = blocks.select(*group, "values", *extra).join(
        state.where(~F.col("done")).select(*group, "centers"), list(group))
    return joined.select(*group, "values", "centers", *extra).mapInArrow(sums, schema)


def _step(blocks: DataFrame, state: DataFrame, group: Sequence[str], clusters: int, tolerance: float,
          labelled: bool) -> DataFrame:
    """Next state: new centers; an empty cluster restarts from the group's farthest row. One pass over the blocks."""
    cells = _partials(blocks, state, group, clusters, labelled).select(
        *group, "cluster", "far", "far_values", F.posexplode(F.arrays_zip("total", "count")).alias("place", "s"))
    # Place 0 has the squared distances and the rows of the cluster.
    places = cells.groupBy(*group, "cluster", "place").agg(
        F.sum("s.total").alias("total"), F.sum("s.count").alias("count"),
        F.max(F.when(F.col("place") == 0, F.struct("far", "far_values"))).alias("far"))
    head = F.col("place") == 0
    found = places.groupBy(*group).agg(
        (F.sum(F.when(head, F.col("total"))) / F.sum(F.when(head, F.col("count")))).alias("now"),
        F.max("far")["far_values"].alias("far"),
        F.sort_array(F.collect_list(F.when(~head, F.struct("cluster", "place", (F.col("total") / F.col("count")).alias("value"))))).alias("found"))

    def center(i: Column) -> Column:
        own = F.filter("found", lambda f: f["cluster"] == i)
        return F.when(F.size(own) > 0, F.transform(own, lambda f: f["value"])).otherwise(F.col("far"))

    moved = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(clusters - 1)), center))
    following = state.join(found, list(group), "left")
    active = F.col("found").isNotNull()
    if labelled:
        # Labels did not change: only the centers move on.
        return following.select(
            *group, F.when(active, moved).otherwise(F.col("centers")).alias("centers"), "inertia", "iterations", "done")
    settled = F.coalesce(F.abs(F.col("inertia") - F.col("now")) < tolerance, F.lit(False))
    return following.select(
        *group,
        # A settled group keeps the centers its last inertia was measured with.
        F.when(active & ~settled, moved).otherwise(F.col("centers")).alias("centers"),
        F.coalesce("now", "inertia").alias("inertia"),
        (F.col("iterations") + active.cast("int")).alias("iterations"),
        (F.col("done") | settled).alias("done"))


def starting_state(centers: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """State of a fit before its first step, from one row of flat ``centers`` per group."""
    return centers.select(*group, "centers", F.lit(None).cast("double").alias("inertia"), F.lit(0).alias("iterations"),
                          F.lit(False).alias("done"))


def fit_dtw_kmeans(df: DataFrame, clusters: int = 5, group: Sequence[str] = GROUP, seed: int = 0,
                   max_iter: int = MAX_ITER, tolerance: float = TOLERANCE, barycenter_steps: int = 1,
                   start: DataFrame | None = None) -> DataFrame:
    """Model table ``(group..., cluster, center, inertia, iterations)``.

    ``df`` has the group columns, ``day`` and ``values`` of one length. Rows with missing values cannot be
    compared and are left out. Ends when no group's inertia moves by ``tolerance``, or after ``max_iter``.
    ``start`` (group..., cluster, center) replaces the seeded draw.
    """
    blocks = materialize(_blocks(df, group, seed), "blocks")
    state = starting_state(_seed_centers(blocks, group, clusters) if start is None else _flat_centers(start, group), group)
    for _ in range(max_iter):
        state = materialize(_step(blocks, state, group, clusters, tolerance, labelled=False), "centers")
        if barycenter_steps > 1:
            near = dtw_labels(F.col("values"), F.col("centers"))
            fixed = materialize(blocks.join(state.select(*group, "centers"), list(group)).withColumn("__near", near).select(
                *group, "values", F.col("__near.cluster").alias("label")), "labels")
            for _ in range(barycenter_steps - 1):
                state = materialize(_step(fixed, state, group, clusters, tolerance, labelled=True), "centers")
        if state.where(~F.col("done")).isEmpty():
            break
    return centers_table(state, clusters, group)


def _flat_centers(model: DataFrame, group: Sequence[str]) -> DataFrame:
    return model.groupBy(*group).agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("cluster", "center"))), lambda s: s["center"])).alias("centers"))


def centers_table(state: DataFrame, clusters: int, group: Sequence[str]) -> DataFrame:
    width = (F.size("centers") / clusters).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(clusters - 1)), lambda i: F.struct(
        i.alias("cluster"), F.slice(F.col("centers"), i * F.col("__w") + 1, F.col("__w")).alias("center")))
    return state.withColumn("__w", width).select(*group, F.explode(parts).alias("c"), "inertia", "iterations").select(
        *group, "c.cluster", "c.center", "inertia", "iterations")


def assign_dtw(df: DataFrame, model: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Add ``cluster`` and ``distance``; a group's centers are joined once per stretch of days, not once a row."""
    others = [c for c in df.columns if c not in group]
    packed = df.where(~F.exists("values", lambda v: v.isNull())).groupBy(*group, _stretch().alias("__block")).agg(
        F.collect_list(F.struct(*others)).alias("__rows"))
    near = dtw_labels(F.col("__rows.values"), F.col("centers"))
    labelled = packed.join(_flat_centers(model, group), list(group)).withColumn("__near", near)
    rows = labelled.select(*group, F.explode(F.arrays_zip("__rows", "__near")).alias("r"))
    return rows.select(*[F.col(c) if c in group else F.col("r.__rows")[c].alias(c) for c in df.columns],
                       F.col("r.__near.cluster").alias("cluster"), F.col("r.__near.distance").alias("distance"))


# --- labels beside each other ------------------------------------------------------------------------

def align_labels(labels: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per station and day, one label column per measurement."""
    return labels.groupBy(*keys, "day").pivot("column", list(columns)).agg(F.first("cluster"))


def with_labels(split: DataFrame, labels: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Series rows with their cluster."""
    return split.join(labels.select(*group, "day", "cluster"), [*group, "day"])


# --- store -------------------------------------------------------------------------------------------

def stored_dtw_model(df: DataFrame, path: str, clusters: int = 5, refit: bool = False, group: Sequence[str] = GROUP,
                     **options) -> DataFrame:
    """Model from the store; groups not in it are fitted and added. A stored model is reused as it is; ``refit`` replaces the
    models of the frame's groups. A version of the store is changed as a whole (:mod:`gustline.versions`)."""
    group = list(group)

    def made(stored: DataFrame | None) -> DataFrame | None:
        todo = df if stored is None or refit else df.join(stored.select(*group).distinct(), group, "left_anti")
        if stored is not None and not refit and todo.isEmpty():
            return None
        fresh = materialize(fit_dtw_kmeans(todo, clusters, group, **options), "model")
        if stored is None or not refit:
            return fresh
        return stored.join(fresh.select(*group).distinct(), group, "left_anti").unionByName(fresh)

    return versions.append(df.sparkSession, path, "dtw", made, instead=refit)


def model_json(model: DataFrame, group: Sequence[str] = GROUP, **hyper_params) -> DataFrame:
    """One JSON document per group: hyper-parameters, centers, inertia, iterations."""
    settings = F.struct(*[F.lit(v).alias(k) for k, v in hyper_params.items()]) if hyper_params else F.lit(None)
    grouped = model.groupBy(*group).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("cluster", "center"))),
                    lambda s: s["center"]).alias("cluster_centers_"),
        F.first("inertia").alias("inertia_"), F.first("iterations").alias("n_iter_"))
    body = F.to_json(F.struct(
        settings.alias("hyper_params"),
        F.struct("cluster_centers_", "inertia_", "n_iter_").alias("model_params")))
    return grouped.select(*group, body.alias("document"))
