"""LOWESS over long series, a row per point, with the results of :mod:`gustline.operators.smooth` and no series in one task.

Points are numbered by range partitions and packed into chunks; fitted points (anchors) into blocks of their own. A block meets
the chunks its windows reach, one at a time, and every such pair gives five sums per anchor; added up over the chunks they are
the weighted line of the anchor, however wide its window. Windows of points that do not lie evenly come from counting the
midpoints below a point. The median of the residuals that the robust weights need is counted, not gathered.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.operators.neighbours import after, before, placed, with_neighbours
from gustline.operators.quantiles import exact_quantiles
from gustline.operators.running import with_row_numbers, with_running_total
from gustline.operators.smooth import DELTA, FAR, FRAC, NEAR, PASSES, _EDGE, _ROUNDING
from gustline.schema import KEYS
from gustline.storage import materialize

# Points of a chunk, anchors of a block, and anchors whose weights are held at once.
CHUNK, BLOCK, _STRIP = 4096, 1024, 64

_RANK, _X, _Y, _N, _K, _W = "__rank", "__x", "__y", "__n", "__k", "__w"
_SUMS = ("s", "su", "suu", "sy", "suy")


def _at_rank(points: DataFrame, keys: list[str], name: str, rank: str) -> DataFrame:
    """(keys, rank, name): the x of every rank, to join by another column of ranks."""
    return points.select(*keys, F.col(_RANK).alias(rank), F.col(_X).alias(name))


def _count_below(points: DataFrame, asked: DataFrame, keys: list[str], strictly: bool) -> DataFrame:
    """``asked`` (keys, id, at) and ``below``: how many ``__x`` of ``points`` lie below (or up to) ``at``."""
    both = points.select(*keys, F.col(_X).cast("double").alias("at"), F.lit(None).cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("weight"),
                         F.lit(1 if strictly else 0).alias("turn"), F.col(_RANK).alias("tie")).union(
        asked.select(*keys, F.col("at").cast("double"), "id", F.lit(0).cast("bigint"), F.lit(0 if strictly else 1), F.col("id")))
    return with_running_total(both, ["at", "turn", "tie"], keys, F.col("weight"), "below").where("id is not null").select(*keys, "id", "below")


def _anchors(points: DataFrame, keys: list[str], delta: float) -> DataFrame:
    """(keys, rank, x, n, k) of the fitted points: all, or of those within ``delta`` of a fitted point only the last one.

    Which they are follows from the first point step by step; the steps are doubled in each turn, for all series at once."""
    if delta <= 0:
        return points.select(*keys, _RANK, _X, _N, _K)
    reach = _count_below(points, points.select(*keys, F.col(_RANK).alias("id"), (F.col(_X) + delta).alias("at")), keys, False)
    jump = materialize(points.join(reach.withColumnRenamed("id", _RANK), [*keys, _RANK]).select(
        *keys, _RANK, F.least(F.col(_N) - 1, F.greatest(F.col(_RANK) + 1, F.col("below") - 1)).alias("to")), "jumps")
    reached = materialize(jump.where(F.col(_RANK) == 0).select(*keys, _RANK), "reached")
    count = reached.count()
    while True:
        more = reached.join(jump, [*keys, _RANK]).select(*keys, F.col("to").alias(_RANK))
        reached = materialize(reached.union(more).distinct(), "reached")
        now = reached.count()
        if now == count:
            break
        count = now
        further = jump.select(*keys, F.col(_RANK).alias("to"), F.col("to").alias("__to"))
        jump = materialize(jump.join(further, [*keys, "to"]).select(*keys, _RANK, F.col("__to").alias("to")), "jumps")
    return points.join(reached, [*keys, _RANK]).select(*keys, _RANK, _X, _N, _K)


def _windows(points: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """Anchors with the rank their window begins at and its radius."""
    right = points.select(*keys, (F.col(_RANK) - F.col(_K)).alias(_RANK), F.col(_X).alias("__right"))
    middles = points.join(right, [*keys, _RANK]).select(*keys, _RANK, ((F.col(_X) + F.col("__right")) / 2).alias(_X))
    begins = _count_below(middles, anchors.select(*keys, F.col(_RANK).alias("id"), F.col(_X).alias("at")), keys, True)
    found = anchors.join(begins.select(*keys, F.col("id").alias(_RANK), F.col("below").alias("begin")), [*keys, _RANK])
    found = found.withColumn("until", F.col("begin") + F.col(_K) - 1)
    found = found.join(_at_rank(points, keys, "__low", "begin"), [*keys, "begin"]).join(_at_rank(points, keys, "__high", "until"), [*keys, "until"])
    radius = F.greatest(F.col(_X) - F.col("__low"), F.col("__high") - F.col(_X))
    return found.select(*keys, _RANK, F.col(_X).cast("double").alias(_X), "begin", "until", radius.cast("double").alias("radius"))


def _blocks(windows: DataFrame, keys: list[str], chunk: int, block: int) -> DataFrame:
    """Anchors packed, a row for every chunk that the windows of a block reach."""
    packed = windows.groupBy(*keys, F.floor(F.col(_RANK) / block).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(_RANK, _X, "begin", "until", "radius"))).alias("a"),
        F.min("begin").alias("low"), F.max("until").alias("high"))
    return packed.select(*keys, "block", F.explode(F.sequence(F.floor(F.col("low") / chunk), F.floor(F.col("high") / chunk))).alias("chunk"), *[
        F.col("a")[c].alias(n) for c, n in ((_RANK, "at"), (_X, "ax"), ("begin", "begin"), ("until", "until"), ("radius", "radius"))])


def _sums(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rank, sums) of every pair of a block and a chunk, added up."""
    schema = T.StructType([*[T.StructField(k, pairs.schema[k].dataType) for k in keys], T.StructField(_RANK, T.LongType()),
                           *[T.StructField(s, T.DoubleType()) for s in _SUMS]])
    many = len(keys)
    source = pairs.select(*keys, "at", "ax", "begin", "until", "radius", "rank", "x", "y", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, ax, begin, until, radius, rank, x, y, w = (
                    np.asarray(batch.column(many + j)[i].values.to_numpy(zero_copy_only=False)) for j in range(9))
                out = np.zeros((5, len(at)))
                for a in range(0, len(at), _STRIP):
                    s = slice(a, a + _STRIP)
                    u = x[None, :] - ax[s, None]
                    share = np.divide(np.abs(u), radius[s, None], out=np.zeros_like(u), where=radius[s, None] > 0)
                    weight = np.where(share <= NEAR, 1.0, np.where(share > FAR, 0.0, (1 - share ** 3) ** 3))
                    weight *= ((rank[None, :] >= begin[s, None]) & (rank[None, :] <= until[s, None])) * w[None, :]
                    out[:, s] = weight.sum(1), (weight * u).sum(1), (weight * u * u).sum(1), weight @ y, (weight * u) @ y
                own = [batch.column(j).take(pa.array(np.full(len(at), i))) for j in range(many)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(at), *map(pa.array, out)], names=schema.names)

    return source.mapInArrow(run, schema).groupBy(*keys, _RANK).agg(*[F.sum(s).alias(s) for s in _SUMS])


def _fitted() -> Column:
    """Value of the weighted line at its anchor, from sums around it; null without weight."""
    total = F.col("s")
    mean_u, mean_y = F.col("su") / total, F.col("sy") / total
    square, cross = F.col("suu") / total - mean_u * mean_u, F.col("suy") / total - mean_u * mean_y
    return F.when(total > 0, mean_y - F.when(square > 1e-12, cross / square).otherwise(0.0) * mean_u)


def smooth_column(df: DataFrame, column: str, keys: Sequence[str] = KEYS, order: Sequence[str] = ("valid",), frac: float = FRAC,
                  passes: int = PASSES, delta: float = DELTA, into: str | None = None, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """Add ``{column}_smooth``: each series smoothed over the places of its rows in the order, which tells the rows apart.

    A row without a value keeps its place, stays without one and takes no part in the fit. Rows without a key belong to no series.
    """
    keys, into = list(keys), into or f"{column}_smooth"
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    rows = materialize(with_row_numbers(known, order, keys, _X), "rows")
    present = rows.where(F.col(column).isNotNull()).select(*keys, _X, F.col(column).cast("double").alias(_Y))
    points = with_row_numbers(present, [_X], keys, _RANK)
    shape = materialize(present.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N), F.max(F.abs(_Y)).alias("__most")), "shape")
    size = F.least(F.col(_N), F.floor(F.lit(float(frac)) * F.col(_N) + 1e-10))
    points = materialize(points.join(shape.withColumn(_K, size), keys), "points")
    wide = points.where(F.col(_K) >= 1)
    windows = _windows(wide, _anchors(wide, keys, delta), keys)
    blocks = materialize(_blocks(windows, keys, chunk, block), "blocks")
    state = materialize(wide.select(*keys, _RANK, _X, _Y, "__most", F.lit(1.0).alias(_W)), "state")
    for turn in range(passes + 1):
        packed = state.groupBy(*keys, F.floor(F.col(_RANK) / chunk).alias("chunk")).agg(
            F.sort_array(F.collect_list(F.struct(_RANK, F.col(_X).cast("double").alias(_X), _Y, _W))).alias("p")).select(*keys, "chunk", *[
                F.col("p")[c].alias(n) for c, n in ((_RANK, "rank"), (_X, "x"), (_Y, "y"), (_W, "w"))])
        found = _sums(blocks.join(packed, [*keys, "chunk"]), keys).select(*keys, _RANK, _fitted().alias("__at"), F.lit(True).alias("__anchor"))
        joined = state.join(found, [*keys, _RANK], "left").withColumn("__fit", F.when(F.col("__anchor"), F.coalesce("__at", _Y))).drop("__at", "__anchor")
        if delta > 0:
            near = with_neighbours(joined, _X, ["__fit"], keys, chunk)
            left, right = before("__fit"), after("__fit")
            between = left["value"] + (right["value"] - left["value"]) / (right["at"] - left["at"]) * (F.col(_X) - left["at"])
            joined = near.withColumn("__fit", F.coalesce("__fit", between)).select(*joined.columns)
        fit = materialize(joined, "fit")
        if turn == passes:
            break
        off = F.abs(F.col(_Y) - F.col("__fit"))
        off = F.when(off <= F.lit(_ROUNDING) * F.col("__most"), F.lit(0.0)).otherwise(off)
        residual = materialize(fit.withColumn("__off", off), "residual")
        scale = materialize(exact_quantiles(residual, keys, "__off", [0.5]).select(*keys, (6 * F.col("quantiles")[0]).alias("__scale")), "scale")
        ratio = F.when(F.col("__scale") > 0, F.col("__off") / F.col("__scale")).when(F.col("__off") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
        weight = F.when(ratio >= 1 - _EDGE, F.lit(0.0)).otherwise(F.pow(1 - F.pow(F.least(ratio, F.lit(1.0)), F.lit(2.0)), F.lit(2.0)))
        state = materialize(residual.join(scale, keys).select(*keys, _RANK, _X, _Y, "__most", weight.alias(_W)), "state")
    smooth = fit.select(*keys, _X, F.col("__fit").alias("__smooth"))
    # Series too short for a window keep their values.
    return rows.join(smooth, [*keys, _X], "left").select(
        *df.columns, F.when(F.col(column).isNotNull(), F.coalesce("__smooth", F.col(column).cast("double"))).alias(into))
