"""Near-duplicates by SimHash: fingerprints of word shingles, linked at few differing bits, and connected components.

Fingerprints are compared exactly, in tiles. A tile holds the distinct fingerprints with the same population counts in
four parts of 16 bits; differing bits are at least the sum of the differences of those counts, so a pair of tiles is
skipped if that sum exceeds the radius. What is left of a pair of tiles is compared by numpy, exclusive-or and bit counts
of a whole block at a time. Tiles are cut into chunks of at most ``chunk`` fingerprints, each chunk is one group of the
exchange, and the fingerprints to hold against it stream by, so a task's memory is bounded however full a tile is. Equal
fingerprints are one row before any of this: a group of thousands of copies costs as much as one text.

Within a group the links found are thinned to a spanning forest, so no group emits all its pairs; components stay whole.

Null and empty texts have fingerprint zero, linked like any other. Null keys: the smallest key that is not null names the
component, null if there is none. Repeated rows each get their own result; empty tables give empty results.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gustline.llm.arrow import annotate, col, utf8
from gustline.llm.components import components
from gustline.storage import materialize

RADIUS, SHINGLE, SEED = 2, 3, 42
PARTS = 4
_WIDTH = 64 // PARTS
#: Fingerprints of a tile that one group holds in memory.
CHUNK = 4096
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits: each is set if it is set in more than half of the hashes of the shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest = xxhash.xxh64_intdigest
    rows = zip(*[words[i:] for i in range(shingle)])
    return majority(np.fromiter((digest(s, SEED) for s in map(b" ".join, rows)), np.uint64, len(words) - shingle + 1))


def majority(h: np.ndarray) -> int:
    """64 bits: each is set if it is set in more than half of the hashes."""
    # How often each value of each byte occurs; then the bits of those values.
    place = h.astype("<u8").view(np.uint8).reshape(-1, 8) + (np.arange(8) << 8)
    counts = np.bincount(place.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits((2 * counts > len(h)).ravel(), bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, keep=None, text: str = "text", name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` (all columns unless given) and the fingerprint as a signed long."""
    def work():
        def run(texts: pa.Array) -> list[pa.Array]:
            data, at = utf8(texts)
            raw, at = data.tobytes(), at.tolist()
            found = [fingerprint(raw[a:b], shingle) for a, b in zip(at, at[1:])]
            return [pa.array(np.array(found, np.uint64).view(np.int64))]
        return run

    return annotate(df, work, StructType([StructField(name, LongType())]), keep, text)


def _profile(fp: str) -> list:
    """Population counts of the parts of a fingerprint."""
    return [F.bit_count(F.shiftrightunsigned(fp, _WIDTH * i).bitwiseAND(F.lit((1 << _WIDTH) - 1))) for i in range(PARTS)]


def _tile(counts: list) -> F.Column:
    out = F.lit(0)
    for c in counts:
        out = out * (_WIDTH + 1) + c
    return out.cast("int")


def _shifts(radius: int) -> list[tuple[int, ...]]:
    """Differences of profiles that allow ``radius`` differing bits; of a difference and its opposite, the positive one."""
    steps = itertools.product(range(-radius, radius + 1), repeat=PARTS)
    return [s for s in steps if 0 < sum(map(abs, s)) <= radius and s > (0,) * PARTS]


def _dealt(distinct: DataFrame, radius: int, chunk: int) -> DataFrame:
    """(tile, chunk, guest, fp): each fingerprint at home once, and as a guest in every chunk it must be held against."""
    named = distinct.select("fp", *[c.alias(f"p{i}") for i, c in enumerate(_profile("fp"))])
    own = named.select("fp", *[f"p{i}" for i in range(PARTS)], _tile([F.col(f"p{i}") for i in range(PARTS)]).alias("tile"))
    # At most 17^4 tiles, whatever the input.
    sizes = own.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    part = F.pmod(F.xxhash64("fp"), F.col("chunks").cast("bigint")).cast("int")
    home = own.join(sizes, "tile").select("tile", "fp", "chunks", part.alias("chunk"))
    at_home = home.select("tile", "chunk", F.lit(0).alias("guest"), "fp")
    same = home.where("chunk > 0").select("tile", F.explode(F.sequence(F.lit(0), F.col("chunk") - 1)).alias("chunk"),
                                          F.lit(1).alias("guest"), "fp")
    near = []
    for s in _shifts(radius):
        moved = [F.col(f"p{i}") + d for i, d in enumerate(s)]
        inside = [(m >= 0) & (m <= _WIDTH) for m in moved]
        near.append(F.when(inside[0] & inside[1] & inside[2] & inside[3], _tile(moved)))
    targets = own.select("fp", F.explode(F.array_compact(F.array(*near))).alias("tile"))
    other = targets.join(sizes, "tile").select(
        "tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("guest"), "fp")
    return at_home.union(same).union(other)


class _Forest:
    """Links within one group: the fingerprints at home, and guests as they come."""

    def __init__(self, home: np.ndarray, radius: int):
        self.home, self.radius = home, radius
        self.above = list(range(len(home)))
        self.out: list[tuple[int, int]] = []
        for begin in range(0, len(home), 512):
            self._hold(home[begin:begin + 512], begin)

    def root(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return i

    def _union(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.above[max(i, j)] = min(i, j)
        return True

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[list[int], list[int]]:
        near = np.bitwise_count(left[:, None] ^ right[None, :]) <= self.radius
        a, b = np.nonzero(near)
        return a.tolist(), b.tolist()

    def _hold(self, block: np.ndarray, begin: int) -> None:
        for a, b in zip(*self._pairs(block, self.home)):
            if b > begin + a and self._union(begin + a, b):
                self.out.append((int(self.home[begin + a]), int(self.home[b])))

    def guests(self, block: np.ndarray) -> None:
        """A guest is linked to the first fingerprint it is near to, and those it is near to with each other."""
        last: dict[int, int] = {}
        for a, b in zip(*self._pairs(block, self.home)):
            if a not in last:
                last[a] = b
                self.out.append((int(block[a]), int(self.home[b])))
            elif self._union(last[a], b):
                self.out.append((int(self.home[last[a]]), int(self.home[b])))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        found = np.array(self.out, np.uint64).reshape(-1, 2)
        self.out = []
        return found[:, 0].view(np.int64) if len(found) else np.zeros(0, np.int64), \
            found[:, 1].view(np.int64) if len(found) else np.zeros(0, np.int64)


_LINKS = StructType([StructField("u", LongType()), StructField("v", LongType())])


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile, chunk and guest: first those at home, then the guests."""
        now, home, forest = None, [], None

        def packed() -> pa.RecordBatch:
            u, v = forest.links()
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(u)), pa.array(np.ascontiguousarray(v))], names=["u", "v"])

        for batch in batches:
            tile, chunk, guest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            key = tile.astype(np.int64) << 32 | chunk
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(guest) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)]):
                if a == b:
                    continue
                if key[a] != now:
                    if now is not None:
                        forest = forest or _Forest(np.concatenate(home) if home else np.zeros(0, np.uint64), radius)
                        yield packed()
                    now, home, forest = key[a], [], None
                if not guest[a]:
                    home.append(fp[a:b])
                    continue
                forest = forest or _Forest(np.concatenate(home) if home else np.zeros(0, np.uint64), radius)
                for i in range(a, b, 512):
                    forest.guests(fp[i:min(b, i + 512)])
        if now is not None:
            forest = forest or _Forest(np.concatenate(home) if home else np.zeros(0, np.uint64), radius)
            yield packed()
    return run


def links(distinct: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) that connect whatever fingerprints are within ``radius`` bits, of distinct fingerprints ``fp``."""
    dealt = _dealt(distinct, radius, chunk)
    grouped = dealt.repartition("tile", "chunk").sortWithinPartitions("tile", "chunk", "guest")
    return grouped.mapInArrow(_compare(radius), _LINKS)


def cluster(prints: DataFrame, key: str = "doc_id", radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint: the smallest fingerprint and the smallest key of all rows
    that can be reached from it."""
    distinct = materialize(prints.groupBy("fp").agg(F.min(col(key)).alias("least")), "distinct")
    found = components(links(distinct.select("fp"), radius, chunk)).withColumnRenamed("node", "fp")
    named = materialize(distinct.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "classes")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` of every row."""
    prints = materialize(fingerprints(df, [key], text), "fingerprints")
    # Many rows may have the same fingerprint; that side of the join is split where it is skewed.
    return prints.join(cluster(prints, key, radius), "fp").select(col(key), "fp", "component_id")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each component, with the columns it had: that with the smallest key, nulls last."""
    names = [c for c in df.columns]
    numbered = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(names)], F.monotonically_increasing_id().alias("row"))
    k, t = f"k{names.index(key)}", f"k{names.index(text)}"
    # Written, so that a row's number is the same whenever it is read.
    prints = materialize(fingerprints(numbered, None, t), "rows")
    small = prints.select("row", "fp", k)
    classes = materialize(cluster(small, k, radius), "classes")
    least = materialize(small.groupBy("fp").agg(F.min(F.struct(F.col(k).isNull().alias("n"), F.col(k).alias("key"), "row")).alias("best")), "best")
    # Keys may be null or repeated, so the row's number decides among equal ones.
    kept = least.join(classes, "fp").groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("row"))
    return prints.join(kept, "row", "left_semi").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)])
