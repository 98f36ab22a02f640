"""Near copies by word shingles: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates are, first, texts whose SimHash fingerprints (of the same shingles) :mod:`gustline.llm.simhash` links. At 0.8 two
fingerprints differ in about 10 of 64 bits, and a radius that finds most of such pairs leaves too few tiles to skip; so what
is further apart than that module's radius are candidates if they share a band of minimum hashes: 40 bands of 6, so that of
pairs at exactly 0.8 about 5 in a million share none, and fewer above. Every candidate is then checked on the shingles of both
texts, so no pair below the limit is linked.

Texts with the same words in the same order are one text before any of this. Of every bucket, the text that shares most buckets
with others is its hub; all others of the bucket are held against it, which joins what was copied from one text in a pair a
text. Texts of a bucket that this leaves outside its largest component meet the rest of the bucket in blocks of some 256 of
them: the texts go there once, pairs are made, checked and forgotten in the task, and what leaves it are links that join
components, fewer than it has texts. No two texts are compared before their sketches, a byte of each of 240 minima, agree nearly
as often as those of texts at the limit do (seven standard deviations below). So no pair is a row, however many texts share a
template; the time of such a bucket, not its rows, grows with outsiders times members.

Null, empty and blank texts are equal; a text of fewer than five words is one shingle. Repeated rows are copies of each other;
empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from gustline.llm import simhash
from gustline.llm.arrow import annotate, col, mix, utf8
from gustline.llm.components import components
from gustline.storage import materialize, scratch_path

LEAST, SHINGLE, SEED = 0.8, 5, 42
BANDS, ROWS = 40, 6
#: Outsiders of a bucket that are held against its members at once, on average.
_TILE = 256
#: Members of a bucket that go to a task at once, on average.
_ANSWERS = 2048
#: Pairs of texts in an Arrow batch.
_PAIRS = 256
#: Shingles hashed at once.
_BLOCK = 512
_DRAWN = np.random.default_rng(SEED).integers(0, 1 << 32, (2, BANDS * ROWS), np.uint64).astype(np.uint32)
_TURN, _FACTOR = _DRAWN[0], _DRAWN[1] | np.uint32(1)


def hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles, repeats included."""
    words = text.lower().split()
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    rows = zip(*[words[i:] for i in range(shingle)])
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, rows)), np.uint64, len(words) - shingle + 1)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted, distinct hashes of the shingles."""
    return np.unique(hashes(text, shingle))


def minima(found: np.ndarray) -> np.ndarray:
    """The minimum of every hash function over the shingles."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), _BLOCK):
        least = np.minimum(least, ((low[i:i + _BLOCK, None] ^ _TURN) * _FACTOR).min(0))
    return least


def buckets(least: np.ndarray) -> np.ndarray:
    """A number per band, equal for texts with the same minima in the band."""
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for part in least.reshape(BANDS, ROWS).T:
        out = (out ^ part) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return mix(out)


def similar(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def agreement(least: float = LEAST) -> int:
    """Equal bytes of two sketches below which texts are taken to be less alike than ``least``."""
    n = BANDS * ROWS
    return int(n * least - 7 * np.sqrt(n * least * (1 - least)))


_MARKS = StructType([StructField("d0", LongType()), StructField("d1", LongType()), StructField("buckets", ArrayType(LongType())),
                     StructField("sketch", BinaryType()), StructField("fp", LongType())])


def _marks(texts: pa.Array) -> list[pa.Array]:
    """A digest of the words in two parts, the buckets, the sketch and the fingerprint."""
    data, at = utf8(texts)
    raw, at = data.tobytes(), at.tolist()
    digests, found, sketches, prints = [], [], [], []
    for a, b in zip(at, at[1:]):
        text = raw[a:b]
        digests.append(xxhash.xxh128_digest(b" ".join(text.lower().split()), SEED))
        every = hashes(text)
        prints.append(simhash.majority(every))
        least = minima(np.unique(every))
        found.append(buckets(least))
        sketches.append(least.astype(np.uint8).tobytes())
    parts = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    every = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * BANDS, pa.array(every))
    return [pa.array(np.ascontiguousarray(parts[:, 0])), pa.array(np.ascontiguousarray(parts[:, 1])), lists,
            pa.array(sketches, pa.binary()), pa.array(np.array(prints, np.uint64).view(np.int64))]


def _short_batches(df: DataFrame):
    """A session of its own that sends whole texts to the tasks in short batches, and a function that reads written tables in it."""
    own = df.sparkSession.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_PAIRS))

    def read(x: DataFrame) -> DataFrame:
        return own.read.schema(x.schema).parquet(*x.inputFiles()) if x.inputFiles() else own.createDataFrame([], x.schema)

    return own, read


_LINKS = StructType([StructField("u", LongType()), StructField("v", LongType())])


def _alike(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose texts are near copies; ``texts`` has (row, t). Both are written tables."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, np.zeros(0, np.uint64)
        for batch in batches:
            us, vs, one, other = batch.columns
            hit = []
            for u, a, b in zip(us.to_pylist(), one, other):
                if u != last:
                    last, mine = u, shingles((a.as_py() or "").encode())
                hit.append(similar(mine, shingles((b.as_py() or "").encode()), least))
            hit = pa.array(hit, pa.bool_())
            yield pa.RecordBatch.from_arrays([us.filter(hit), vs.filter(hit)], names=["u", "v"])

    spark = pairs.sparkSession
    _, read = _short_batches(texts)
    pairs, texts = read(pairs), read(texts)
    left = texts.select(F.col("row").alias("u"), F.col("t").alias("a"))
    right = texts.select(F.col("row").alias("v"), F.col("t").alias("b"))
    path = scratch_path(spark, "near")
    pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, _LINKS).write.parquet(path)
    return spark.read.schema(_LINKS).parquet(path)


def _matrix(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).reshape(len(sketches), BANDS * ROWS)


def _promising(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose sketches agree well enough to look at their texts."""
    need = agreement(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = pa.array((_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(1) >= need)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(hit), batch.column(1).filter(hit)], names=["u", "v"])

    left = texts.select(F.col("row").alias("u"), F.col("sketch").alias("a"))
    right = texts.select(F.col("row").alias("v"), F.col("sketch").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, _LINKS)


def _outsiders(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (u, v) of members (bucket, row, root) outside the largest component of their bucket with members of other
    components: of the links that a block holds, those that join components."""
    need = agreement(least)
    counted = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = counted.groupBy("bucket").agg(F.max_by("root", F.struct("n", -F.col("root"))).alias("main"), F.sum("n").alias("every"), F.max("n").alias("most"))
    main = materialize(main.where("most < every").select("bucket", "main", F.ceil((F.col("every") - F.col("most")) / _TILE).alias("blocks"),
                                                             F.ceil(F.col("every") / _ANSWERS).alias("parts")), "main")
    placed = materialize(members.join(main, "bucket"), "placed")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    # A block of outsiders asks all parts of the bucket; every member answers in its part, to all blocks.
    asking = placed.where("root <> main").select("bucket", F.pmod(F.xxhash64("row"), F.col("blocks")).alias("block"), every("parts").alias("part"),
                                                 F.lit(True).alias("asks"), "row", "root")
    answering = placed.select("bucket", every("blocks").alias("block"), F.pmod(F.xxhash64("row"), F.col("parts")).alias("part"),
                              F.lit(False).alias("asks"), "row", "root")
    blocks = asking.union(answering).join(texts, "row").select("bucket", "block", "part", "asks", "row", "root", "t", "sketch")

    def joined(rows: pa.Table) -> pa.RecordBatch:
        row, root, asks = (rows[c].to_numpy(zero_copy_only=False) for c in ("row", "root", "asks"))
        sketch, text = _matrix(rows["sketch"].combine_chunks()), rows["t"]
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        found = []
        for a in range(0, len(left), 64):
            one = left[a:a + 64]
            for k in range(0, len(right), 64):
                other = right[k:k + 64]
                same = (sketch[one][:, None, :] == sketch[other][None, :, :]).sum(2)
                x, y = np.nonzero((same >= need) & (root[one][:, None] != root[other][None, :]))
                found.append(np.column_stack([same[x, y], one[x], other[y]]))
        found = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        above: dict[int, int] = {}
        known: dict[int, np.ndarray] = {}

        def top(r: int) -> int:
            while r in above:
                r = above[r]
            return r

        def of(i: int) -> np.ndarray:
            if i not in known:
                known[i] = shingles((text[i].as_py() or "").encode())
            return known[i]

        links = []
        for i, j in found[np.argsort(-found[:, 0], kind="stable"), 1:].tolist():
            x, y = top(int(root[i])), top(int(root[j]))
            if x != y and similar(of(i), of(j), least):
                above[max(x, y)] = min(x, y)
                links.append((int(row[i]), int(row[j])))
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = np.column_stack([table[c].to_numpy() for c in ("bucket", "block", "part")])
            begin = np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1) if len(keys) else np.zeros(0, np.int64)
            for a, b in zip(begin.tolist(), begin[1:].tolist()):
                yield joined(table.slice(a, b - a))
            held = table.slice(int(begin[-1])) if len(begin) else None
        if held is not None and held.num_rows:
            yield joined(held)

    return blocks.repartition("bucket", "block", "part").sortWithinPartitions("bucket", "block", "part").mapInArrow(run, _LINKS)


def _printed(rows: DataFrame) -> DataFrame:
    """Pairs (u, v) of rows (row, fp) by their fingerprints: each row with the first of its fingerprint, and the first rows of
    fingerprints that SimHash links. No more pairs than rows and links."""
    rows = materialize(rows, "prints")
    first = materialize(rows.groupBy("fp").agg(F.min("row").alias("first")), "first")
    same = rows.join(first, "fp").where("row <> first").select(F.col("first").alias("u"), F.col("row").alias("v"))
    sides = [first.select(F.col("fp").alias(c), F.col("first").alias(f"first_{c}")) for c in ("u", "v")]
    met = simhash.links(first.select("fp")).join(sides[0], "u").join(sides[1], "v")
    return same.union(met.select(F.col("first_u").alias("u"), F.col("first_v").alias("v")))


def links(rows: DataFrame, least: float = LEAST) -> DataFrame:
    """Links (u, v) that connect whatever rows are near copies, of rows (row, t, buckets, sketch, fp) with distinct texts."""
    printed = materialize(_printed(rows.select("row", "fp")), "printed")
    members = rows.select("row", F.explode("buckets").alias("bucket"))
    busy = materialize(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "busy")
    shared = materialize(members.join(busy, "bucket"), "shared")
    # The more buckets a text shares with others, the nearer it is to what they were copied from.
    degree = shared.groupBy("row").agg(F.sum("n").alias("degree"))
    hubs = shared.join(degree, "row").groupBy("bucket").agg(F.max_by("row", F.struct("degree", -F.col("row"))).alias("hub"))
    wanted = degree.select("row").union(printed.select("u")).union(printed.select("v"))
    texts = materialize(rows.join(wanted, "row", "left_semi").select("row", "t", "sketch"), "texts")
    pairs = shared.join(hubs, "bucket").where("row <> hub").select(F.col("hub").alias("u"), F.col("row").alias("v"))
    pairs = pairs.union(printed.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))).distinct()
    near = _alike(materialize(_promising(pairs, texts, least), "pairs"), texts, least)
    known = components(near).withColumnRenamed("node", "row")
    named = materialize(shared.join(known, "row", "left").select("bucket", "row", F.coalesce("root", "row").alias("root")), "named")
    own, read = _short_batches(texts)
    more = _outsiders(read(named), read(texts), least)
    path = scratch_path(own, "near")
    more.write.parquet(path)
    return near.union(rows.sparkSession.read.schema(_LINKS).parquet(path))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """One row of each group of near copies, with the columns it had: that with the smallest key, nulls last."""
    names = list(df.columns)
    numbered = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(names)], F.monotonically_increasing_id().alias("row"))
    k, t = f"k{names.index(key)}", f"k{names.index(text)}"
    # Written, so that a row's number is the same whenever it is read.
    rows = materialize(annotate(numbered, lambda: _marks, _MARKS, None, t), "rows")
    order = F.struct(F.col(k).isNull().alias("n"), F.col(k).alias("key"), F.col("row").alias("row"))
    best = materialize(rows.select("d0", "d1", order.alias("best")).groupBy("d0", "d1").agg(F.min("best").alias("best"))
                       .select(F.col("best.row").alias("row"), "best"), "best")
    distinct = rows.select("row", F.col(t).cast("string").alias("t"), "buckets", "sketch", "fp").join(best.select("row"), "row", "left_semi")
    found = components(links(distinct, least)).withColumnRenamed("node", "row")
    kept = best.join(found, "row", "left").groupBy(F.coalesce("root", "row").alias("root")).agg(F.min("best").alias("best"))
    return rows.join(kept.select(F.col("best.row").alias("row")), "row", "left_semi").select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(names)])
