"""Mixing overlapping sources to target weights by minimum-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to. Words flow from a pattern, at most
``repeats`` times its words, to the quotas of its sources; the r-th use of a word costs r, so nothing is repeated while
something unused can serve. Costs rise with each use and paths through the network cost nothing else, so pushing the
largest flow for the first use, then for the second and so on, is a minimum-cost flow.

The flow says how many words each pattern gives. Every document of a pattern is taken as many whole times as fits; the
rest goes to documents in the order of a seeded hash. The order is cut by bucket sums: only the documents of the one
bucket that holds the cut are ordered one by one, and the document at the cut is taken in part, so quotas are met to the
word. The driver holds one number per pattern and source. A source with a third of all rows is one pattern: its rows are
aggregated before they are exchanged and never meet in one task.

Null text has size 0. A null source is a source of its own, last in order; an empty set of sources gives nothing. A null
key has the hash of null. Repeated rows each count. Empty tables give empty results.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.arrow import col
from gustline.storage import materialize

BUCKET_BITS = 12
SEED = 20_240
Source = str | None


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def in_order(sources: Sequence[Source]) -> list[Source]:
    """By code point, null last."""
    return sorted(set(sources), key=lambda s: (s is None, s or ""))


def targets(sizes: dict[Source, int], weights: dict[Source, float], share: float, most: float) -> dict[Source, float]:
    """``share`` times all sizes, by weight; a target stops at ``most`` times its source's size and what is left over is
    shared by weight among the others, until none is above."""
    left, open_ = share * sum(sizes.values()), list(sizes)
    out: dict[Source, float] = {}
    while open_:
        total = sum(weights[s] for s in open_)
        full = [s for s in open_ if total <= 0 or left * weights[s] / total > most * sizes[s]]
        if not full:
            return out | {s: left * weights[s] / total for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


class _Network:
    """Largest flow by shortest augmenting paths in levels. Capacities are whole words."""

    def __init__(self):
        self.to: list[int] = []
        self.room: list[int] = []
        self.out: dict[int, list[int]] = {}

    def arc(self, a: int, b: int, room: int) -> int:
        for x, y, r in ((a, b, room), (b, a, 0)):
            self.out.setdefault(x, []).append(len(self.to))
            self.to.append(y)
            self.room.append(r)
        return len(self.to) - 2

    def fill(self, start: int, end: int) -> None:
        while True:
            level = {start: 0}
            queue = deque([start])
            while queue:
                x = queue.popleft()
                for e in self.out.get(x, ()):
                    if self.room[e] > 0 and self.to[e] not in level:
                        level[self.to[e]] = level[x] + 1
                        queue.append(self.to[e])
            if end not in level:
                return
            at = dict.fromkeys(self.out, 0)
            path: list[int] = []
            x = start
            while True:
                if x == end:
                    push = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= push
                        self.room[e ^ 1] += push
                    cut = next(i for i, e in enumerate(path) if not self.room[e])
                    x = self.to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                arcs = self.out.get(x, [])
                while at[x] < len(arcs):
                    e = arcs[at[x]]
                    if self.room[e] > 0 and level.get(self.to[e]) == level[x] + 1:
                        break
                    at[x] += 1
                if at[x] < len(arcs):
                    path.append(arcs[at[x]])
                    x = self.to[path[-1]]
                elif path:
                    at[self.to[path[-1] ^ 1]] += 1
                    x = self.to[path.pop() ^ 1]
                else:
                    break


def flow(supply: dict[str, int], members: dict[str, list[Source]], quotas: dict[Source, int], repeats: int = 2) -> dict[tuple[str, Source], int]:
    """Words that go from each pattern to each of its sources, at least cost."""
    patterns, sources = sorted(supply), in_order(list(quotas))
    net = _Network()
    first, end = 1, 1 + len(patterns) + len(sources)
    of = {s: first + len(patterns) + i for i, s in enumerate(sources)}
    feeds, ways = {}, {}
    for i, p in enumerate(patterns):
        feeds[p] = net.arc(0, first + i, 0)
        for s in members[p]:
            ways[p, s] = net.arc(first + i, of[s], repeats * supply[p])
    for s in sources:
        net.arc(of[s], end, quotas[s])
    for _ in range(repeats):
        # One more use of every word; it is only reached for when cheaper uses are exhausted.
        for p in patterns:
            net.room[feeds[p]] += supply[p]
        net.fill(0, end)
    return {k: net.room[e ^ 1] for k, e in ways.items()}


def sized(df: DataFrame, sources: Column, key: str = "doc_id", text: str = "text", seed: int = SEED, size: Column | None = None) -> list[Column]:
    """Size, pattern (JSON of the sorted distinct sources) and place in the seeded order, as columns."""
    return [(words(col(text)) if size is None else size).alias("size"),
            F.to_json(F.sort_array(F.array_distinct(sources))).alias("pattern"), F.xxhash64(col(key), F.lit(seed)).alias("place")]


def capacities(rows: DataFrame) -> dict[str, int]:
    """Words of every pattern. Combined in the tasks before the exchange."""
    return {r["pattern"]: int(r["n"]) for r in rows.groupBy("pattern").agg(F.sum("size").alias("n")).collect() if r["pattern"] is not None}


_BUCKET = "shiftrightunsigned(place, %d)" % (64 - BUCKET_BITS)


def cuts(rows: DataFrame, used: dict[str, int], supply: dict[str, int]) -> DataFrame:
    """Of each pattern: how many whole times it is taken, how many words more, and in which bucket of the order they end."""
    plan = []
    for p, n in sorted(used.items()):
        whole, rest = divmod(n, supply[p]) if supply[p] else (0, 0)
        plan.append((p, whole, rest))
    per = rows.sparkSession.createDataFrame(plan, "pattern string, whole bigint, rest bigint")
    sums = rows.groupBy("pattern", F.expr(_BUCKET).alias("bucket")).agg(F.sum("size").alias("n"))
    # At most 2^12 rows for each pattern.
    order = Window.partitionBy("pattern").orderBy("bucket")
    last = sums.withColumn("before", F.sum("n").over(order) - F.col("n")).join(per, "pattern").where("before <= rest").groupBy("pattern").agg(
        F.max(F.struct("bucket", "before")).alias("cut"), F.first("whole").alias("whole"), F.first("rest").alias("rest"))
    return materialize(last.select("pattern", F.col("cut.bucket").alias("edge"), F.col("cut.before").alias("before"), "whole", "rest"), "cuts")


def take(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows, which have key, size, pattern and place, with ``taken``: words of each that make up what its pattern gives."""
    known = rows.withColumn("bucket", F.expr(_BUCKET)).join(plan, "pattern", "left")
    clear = known.where("edge IS NULL OR bucket <> edge").withColumn(
        "more", F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(F.lit(0)))
    within = Window.partitionBy("pattern").orderBy("place", "key", "size").rowsBetween(Window.unboundedPreceding, 0)
    edge = known.where("bucket = edge").withColumn("until", F.sum("size").over(within)).withColumn(
        "more", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before") - F.col("until") + F.col("size")))).drop("until")
    taken = (F.coalesce("whole", F.lit(0)) * F.col("size") + F.col("more")).cast("bigint")
    return clear.unionByName(edge).withColumn("taken", taken).select(*rows.columns, "taken")


def mix(df: DataFrame, sources: Column, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, repeats: int = 2,
        key: str = "doc_id", text: str = "text", seed: int = SEED, whole_rows: bool = False) -> tuple[DataFrame, DataFrame]:
    """The documents and the sources (``source``, ``source_size``, ``target``). The weights repeat over the sources in order.
    No document is taken more than ``repeats`` times.

    The documents have key, size, pattern, place and ``taken``; with ``whole_rows`` they have all their columns, as k0, k1
    and so on, and their rows are not exchanged (but for those of the buckets that hold a cut).
    """
    extra = sized(df, sources, key, text, seed)
    rows = materialize(df.select(col(key).alias("key"), *extra), "sized")
    supply = capacities(rows)
    members = {p: json.loads(p) for p in supply}
    sizes: dict[Source, int] = {}
    for p, n in supply.items():
        for s in members[p]:
            sizes[s] = sizes.get(s, 0) + n
    ordered = in_order(list(sizes))
    target = targets({s: sizes[s] for s in ordered}, {s: weights[i % len(weights)] for i, s in enumerate(ordered)}, share, most)
    flows = flow(supply, members, {s: round(t) for s, t in target.items()}, repeats)
    used = {p: sum(flows[p, s] for s in members[p]) for p in supply}
    table = df.sparkSession.createDataFrame([(s, sizes[s], float(target[s])) for s in ordered], "source string, source_size bigint, target double")
    plan = cuts(rows, used, supply)
    if whole_rows:
        rows = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(df.columns)], col(key).alias("key"), *extra)
    return take(rows, plan), table


def mixed(df: DataFrame, sources: Column, **settings) -> DataFrame:
    """The documents that the mix takes, with the columns they had and ``taken``; a column of that name gives way."""
    taken, _ = mix(df, sources, whole_rows=True, **settings)
    return taken.where("taken > 0").select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() != "taken"], "taken")
