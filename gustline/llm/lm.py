"""Scoring text with a hashed maximum-entropy model.

The probability of a word is that of its class given the words before it, times that of the word within its class. Classes
come from a word's last letters. The first factor is a softmax over classes whose scores are sums of hashed n-gram features
(the word before, the classes of the two before) and of skip features (which classes the words further back had), the second
a softmax over the class's words with their counts as only feature, whose best solution is their smoothed share. Each class
keeps room for words that were never seen, so probabilities of all words add up to one.

1. Texts become token tables, in blocks of a few megabytes of text: numbers of words within the block, hashes and classes of
   the block's distinct words, written once. One count table over all training tokens is made from them; its work and its
   exchange grow with the corpus.
2. Weights are trained by distributed gradient updates, in rounds: every task goes through its blocks of the round in small
   batches, from the weights all tasks got; the changes of all tasks are averaged, feature by feature, each weighted by how
   often the task saw the feature. Tasks and driver hold one table of weights of a fixed size.
3. Counts meet the blocks that need them by two joins, first on the word, then on the block, and each block is scored as
   a few sparse numpy batches. No task or driver holds a vocabulary.

Words are told apart by 64-bit hashes. Null and empty texts are one token, the end. Rows without a text part from nobody:
repeated rows each get their own result. An empty training part leaves uniform weights and counts of zero.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType)

from gustline.llm.arrow import LOWER, WORD, col, hashes, mix, pieces, spans, utf8
from gustline.storage import materialize

CLASSES = 64
ROWS = 1 << 13
BATCH = 4096
BLOCK_BYTES = 8 << 20
ROUNDS = 2
RATE = 0.2
_PARTS = 32
_END = np.uint64(0x0E4D0E4D0E4D0E4D)
_START = np.uint64(0x57A127AB57A127AB)
#: Skip features look at so many tokens, before the stretch of tokens that a token is in.
_SPAN, _STRETCH = 64, 8


@dataclass(frozen=True)
class Settings:
    classes: int = CLASSES
    rows: int = ROWS
    rounds: int = ROUNDS
    rate: float = RATE
    batch: int = BATCH


def tokens(texts: pa.Array, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and class of every token, an end after each text, and the number of tokens of each text."""
    data, at = utf8(texts)
    data = LOWER[data]
    begin, end, first = spans(data, at, WORD)
    size = np.diff(first) + 1
    total = int(size.sum())
    h, c = np.full(total, _END), np.zeros(total, np.uint8)
    place = np.arange(len(begin)) + np.repeat(np.arange(len(size)), np.diff(first))
    h[place] = hashes(data, begin, end)
    # The last three bytes, fewer in shorter words.
    tail = data[end - 1].astype(np.uint64)
    for i in (2, 3):
        tail = tail << np.uint64(8) | np.where(end - begin >= i, data[np.maximum(end - i, 0)], 0).astype(np.uint64)
    c[place] = 1 + mix(tail + np.uint64(1)) % np.uint64(classes - 1)
    return h, c, size


class Context:
    """What is known before each token: the row of the weight table for the hashed word before it and that for the hashed
    classes of the two before it; and, for the words skipped, how often each class was in the ``_SPAN`` tokens before the
    stretch of ``_STRETCH`` tokens that the token is in, as a share."""

    def __init__(self, h: np.ndarray, c: np.ndarray, size: np.ndarray, s: Settings):
        n, k = len(h), s.classes
        self.c, self.s = c, s
        first = np.repeat(np.cumsum(size) - size, size)
        inside = np.arange(n) - first
        word = np.concatenate([[_START], h[:-1]])[:n]
        word[inside < 1] = _START
        one, two = (np.concatenate([np.zeros(m, np.uint8), c])[:n].astype(np.uint64) for m in (1, 2))
        one[inside < 1] = 0
        two[inside < 2] = 0
        with np.errstate(over="ignore"):
            pair = mix((one << np.uint64(8) | two) + np.uint64(1 << 32))
        # Half of the rows for words, half for pairs.
        half = np.uint64(s.rows // 2 - 1)
        self.at = np.column_stack([mix(word) & half, (pair & half) + np.uint64(s.rows // 2)]).astype(np.int32)
        # Stretches of all texts, one after another, and how often each class is in them.
        many = -(-size // _STRETCH)
        base = np.cumsum(many) - many
        self.stretch = (np.repeat(base, size) + inside // _STRETCH).astype(np.int32)
        total = int(many.sum())
        self.counts = np.zeros((total, k), np.uint8)
        for low in range(0, n, 1 << 18):
            np.add.at(self.counts.reshape(-1), self.stretch[low:low + (1 << 18)].astype(np.int64) * k + c[low:low + (1 << 18)], np.uint8(1))
        self.begin = np.maximum(np.repeat(base, many), np.arange(total) - _SPAN // _STRETCH).astype(np.int32)

    def skips(self, low: int, high: int) -> np.ndarray:
        """Shares of the classes in the tokens skipped before each of the stretches low to high."""
        from_ = max(0, low - _SPAN // _STRETCH)
        run = np.zeros((high - from_ + 1, self.s.classes), np.float32)
        np.cumsum(self.counts[from_:high], axis=0, dtype=np.float32, out=run[1:])
        out = run[low - from_:high - from_] - run[self.begin[low:high] - from_]
        out /= np.maximum(out.sum(1, keepdims=True), 1)
        return out

    def stretches(self, i: int, j: int) -> tuple[int, int, np.ndarray]:
        """Stretches of the tokens i to j, and where each token's is among them."""
        low, high = int(self.stretch[i]), int(self.stretch[j - 1]) + 1
        return low, high, self.stretch[i:j] - low

    def logits(self, weights: np.ndarray, i: int, j: int) -> np.ndarray:
        low, high, own = self.stretches(i, j)
        shared = self.skips(low, high) @ weights[self.s.rows:-1]
        shared += weights[-1]
        out = shared[own]
        more = np.empty_like(out)
        for k in range(self.at.shape[1]):
            np.take(weights, self.at[i:j, k], axis=0, out=more, mode="clip")
            out += more
        out -= out.max(1, keepdims=True)
        return out


def log_classes(weights: np.ndarray, context: Context, step: int = 1024) -> np.ndarray:
    """Natural logarithm of the probability of each token's class."""
    n = len(context.c)
    out = np.empty(n, np.float64)
    for i in range(0, n, step):
        j = min(n, i + step)
        x = context.logits(weights, i, j)
        own = x[np.arange(j - i), context.c[i:j]].astype(np.float64)
        np.exp(x, out=x)
        out[i:j] = own - np.log(x.sum(1))
    return out


class Trainer:
    """Adaptive gradient steps on a copy of the weights."""

    def __init__(self, weights: np.ndarray, s: Settings):
        self.start, self.w, self.s = weights, weights.copy(), s
        self.square = np.full(len(weights), 1.0, np.float32)
        self.seen = np.zeros(len(weights), np.float64)

    def learn(self, context: Context) -> None:
        n = len(context.c)
        for i in range(0, n, self.s.batch):
            self._step(context, i, min(n, i + self.s.batch))

    def _step(self, context: Context, i: int, j: int) -> None:
        rows, k, at = self.s.rows, self.s.classes, context.at[i:j]
        g = context.logits(self.w, i, j)
        np.exp(g, out=g)
        g *= 1 / g.sum(1, keepdims=True)
        g[np.arange(j - i), context.c[i:j]] -= 1
        # Hashed features are sparse: tokens are ordered by row, 16-bit numbers by counting, and summed row by row.
        for column in range(at.shape[1]):
            row = at[:, column].astype(np.uint16)
            order = np.argsort(row, kind="stable")
            row = row[order]
            starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            self._move(row[starts], np.add.reduceat(g[order], starts, axis=0), np.diff(np.append(starts, j - i)))
        low, high, own = context.stretches(i, j)
        starts = np.searchsorted(own, np.arange(high - low))
        shared, skips = np.add.reduceat(g, starts, axis=0), context.skips(low, high)
        share = np.diff(np.append(starts, j - i)) @ skips
        self._move(np.arange(rows, rows + k + 1), np.vstack([skips.T @ shared, shared.sum(0)]), np.append(share, j - i))

    def _move(self, rows: np.ndarray, sums: np.ndarray, times: np.ndarray) -> None:
        self.square[rows] += np.einsum("ij,ij->i", sums, sums) / self.s.classes
        self.w[rows] -= (self.s.rate / np.sqrt(self.square[rows]))[:, None] * sums
        self.seen[rows] += times


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def token_table(df: DataFrame, learn: Column, key: str, text: str, classes: int) -> DataFrame:
    """A row per block of texts: keys, whether they are learned from, tokens of each, word numbers, hashes, classes."""
    schema = StructType([
        StructField("block", LongType()), StructField("keys", ArrayType(df.schema[key].dataType)), StructField("learn", ArrayType(BooleanType())),
        StructField("sizes", ArrayType(IntegerType())), StructField("numbers", BinaryType()), StructField("words", BinaryType()),
        StructField("kinds", BinaryType())])
    source = df.select(col(key).alias("key"), F.coalesce(learn, F.lit(False)).alias("learn"), col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch, "t", BLOCK_BYTES):
                h, c, size = tokens(piece.column(2), classes)
                words, first, numbers = np.unique(h, return_index=True, return_inverse=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), _listed(piece.column(0)), _listed(piece.column(1)),
                    _listed(pa.array(size.astype(np.int32))), pa.array([_pack(numbers.astype(np.uint32))], pa.binary()),
                    pa.array([_pack(words)], pa.binary()), pa.array([_pack(c[first])], pa.binary())], names=[f.name for f in schema])
                number += 1

    return source.mapInArrow(run, schema)


def _listed(a: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)


class _Block:
    def __init__(self, row: dict):
        self.number, self.keys = row["block"], row["keys"]
        self.size = np.array(row["sizes"], np.int64)
        self.learn = np.array(row["learn"], bool)
        self.numbers = _unpack(row["numbers"], np.uint32)
        self.words = _unpack(row["words"], np.uint64)
        self.kinds = _unpack(row["kinds"], np.uint8)

    def part(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, hashes, classes and sizes of the texts that are marked."""
        numbers = self.numbers if mask.all() else self.numbers[np.repeat(mask, self.size)]
        return numbers, self.words[numbers], self.kinds[numbers], self.size[mask]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block(batch.slice(i, 1).to_pylist()[0])


#: ``use`` is the times in training texts, shifted by 8 bits, and the class.
_USES = StructType([StructField("word", LongType()), StructField("block", LongType()), StructField("place", IntegerType()),
                    StructField("use", LongType())])
_TOTALS = StructType([StructField("kind", IntegerType()), StructField("n", LongType())])


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of every block."""
    for b in _blocks(batches):
        n = np.bincount(b.part(b.learn)[0], minlength=len(b.words)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(b.words.view(np.int64)), pa.array(np.full(len(n), b.number, np.int64)), pa.array(np.arange(len(n), dtype=np.int32)),
            pa.array(n << 8 | b.kinds)], names=[f.name for f in _USES])


def _totals(classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Training tokens of each class."""
        n = np.zeros(classes, np.int64)
        for b in _blocks(batches):
            n += np.bincount(b.part(b.learn)[2], minlength=classes)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes, dtype=np.int32)), pa.array(n)], names=[f.name for f in _TOTALS])
    return run


_CHANGES = StructType([StructField("part", IntegerType()), StructField("change", BinaryType()), StructField("seen", BinaryType())])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the changes by part of the table; a task holds one sum for each part it got."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for part, change, seen in zip(*[c.to_pylist() for c in batch.columns]):
            x, y = np.frombuffer(change, np.float64), np.frombuffer(seen, np.float64)
            if part in held:
                held[part][0] += x
                held[part][1] += y
            else:
                held[part] = [x.copy(), y.copy()]
    for part, (x, y) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([x.tobytes()]), pa.array([y.tobytes()])],
                                         names=[f.name for f in _CHANGES])


def train(table: DataFrame, s: Settings = Settings()) -> np.ndarray:
    """Weights, from the training texts of all blocks. Each block is learned from in one of the rounds."""
    context = table.sparkSession.sparkContext
    # Hashed features, then a row for each skipped class, then the constant.
    weights = np.zeros((s.rows + s.classes + 1, s.classes), np.float32)
    step = -(-len(weights) // _PARTS)
    for turn in range(s.rounds):
        sent = context.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(sent.value, s)
            for b in _blocks(batches):
                _, h, c, size = b.part(b.learn)
                trainer.learn(Context(h, c, size, s))
            if not trainer.seen.any():
                return
            change = (trainer.w - trainer.start).astype(np.float64) * trainer.seen[:, None]
            for part in range(_PARTS):
                rows = slice(part * step, (part + 1) * step)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([change[rows].tobytes()]),
                                                  pa.array([trainer.seen[rows].tobytes()])], names=[f.name for f in _CHANGES])

        blocks = table.where(F.pmod(F.xxhash64("block"), F.lit(s.rounds)) == turn)
        sums = blocks.mapInArrow(run, _CHANGES).repartition(_PARTS, "part").mapInArrow(_added, _CHANGES)
        # Rows of the table times classes: the same size for any corpus.
        weights = weights.copy()
        for r in sums.collect():
            rows = slice(r["part"] * step, (r["part"] + 1) * step)
            seen = np.frombuffer(r["seen"], np.float64)
            change = np.frombuffer(r["change"], np.float64).reshape(-1, s.classes)
            weights[rows] += (change / np.maximum(seen, 1)[:, None]).astype(np.float32)
        sent.unpersist()
    return weights


_SCORES = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def score(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Of every row: key, n_tokens, n_known, train_tokens, base_score (unigrams with half a count added to each) and score,
    both log10 probabilities. Rows for which ``learn`` holds are what is learned from."""
    s = settings
    table = materialize(token_table(df, learn, key, text, s.classes), "tokens")
    # One exchange by word; a word is in a row per block, so even the most frequent word has few rows.
    by_word = Window.partitionBy("word")
    known = table.mapInArrow(_uses, _USES).select(
        "block", "place", F.sum(F.shiftright("use", 8)).over(by_word).alias("c"),
        # Each word's class is taken down at one of its blocks.
        F.when(F.col("block") == F.min("block").over(by_word), F.col("use").bitwiseAND(F.lit(255)).cast("tinyint")).alias("kind"))
    per_block = materialize(known.where("c > 0").groupBy("block").agg(
        F.collect_list("place").alias("places"), F.collect_list("c").alias("counts"), F.collect_list("kind").alias("found")), "counts")
    total, kinds = np.zeros(s.classes), np.zeros(s.classes)
    # At most as many rows as classes.
    for r in table.select("block", "keys", "learn", "sizes", "numbers", "words", "kinds").mapInArrow(
            _totals(s.classes), _TOTALS).groupBy("kind").agg(F.sum("n").alias("n")).collect():
        total[r["kind"]] = r["n"]
    for r in per_block.select(F.explode("found").alias("kind")).groupBy("kind").count().collect():
        kinds[r["kind"]] = r["count"]
    weights = train(table, s)
    sent = df.sparkSession.sparkContext.broadcast((weights, total, kinds))
    joined = table.join(per_block.drop("found"), "block", "left")
    schema = StructType([StructField(key, df.schema[key].dataType), *[StructField(n, LongType()) for n in _SCORES[:3]],
                         *[StructField(n, DoubleType()) for n in _SCORES[3:]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, total, kinds = sent.value
        n, v = float(total.sum()), float(kinds.sum())
        below = math.log10(n + 0.5 * (v + 1))
        within = np.log(total + 0.5 * (kinds + 1))
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                b = _Block(row.select(["block", "keys", "learn", "sizes", "numbers", "words", "kinds"]).to_pylist()[0])
                c = np.zeros(len(b.words), np.float64)
                got = row.column("places")[0]
                if got.is_valid:
                    c[got.values.to_numpy()] = row.column("counts")[0].values.to_numpy()
                numbers, h, kind, size = b.part(np.ones(len(b.size), bool))
                first = np.cumsum(size) - size
                base = np.add.reduceat((np.log10(c + 0.5) - below)[numbers], first)
                ratio = np.log(c + 0.5) - within[b.kinds]
                model = log_classes(w, Context(h, kind, size, s)) + ratio[numbers]
                yield pa.RecordBatch.from_arrays([
                    row.column("keys")[0].values, pa.array(size), pa.array(np.add.reduceat((c > 0)[numbers].astype(np.int64), first)),
                    pa.array(np.full(len(size), int(n))), pa.array(base), pa.array(np.add.reduceat(model, first) / math.log(10))],
                    names=[f.name for f in schema])

    return joined.mapInArrow(run, schema)
