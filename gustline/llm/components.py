"""Connected components of links by alternating star steps. Everything stays in DataFrames; each step is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.storage import materialize


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and the nodes v linked to it. Combined before the exchange, so hubs are cheap."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_smallest(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_smallest(down), "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        joined.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v): root is the smallest node that can be reached.

    Links may repeat and be in either direction; a link of a node with itself counts for nothing. Nodes are never null.
    Large and small stars alternate until a round leaves the links as they are; the number of rounds grows with the
    logarithm of the number of nodes. The driver sees two numbers a round.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
        now = materialize(_small_star(_large_star(now)), "links")
    # A star per component: every node but the root is linked to the root.
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
