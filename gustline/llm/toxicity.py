"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text: both end in the same part, trained by zstandard on ordinary text;
before it stands a small part of the class's own, the words that are overrepresented in texts of that class, strongest
last. A window of words compresses better with the toxic dictionary only if it holds something that ordinary text has
not. The difference of the two lengths, over the windows of a text, is mapped to a probability by limits and weights that
are calibrated on labelled texts the dictionaries have not seen.

The fit reads whole texts of a bounded number of labelled rows (``Settings``); words and figures of these are counted in the
tasks, and the driver gets counts, the windows that a dictionary is trained on, and a few figures a row. Scoring reads every
whole text. Null and empty texts have one empty window, so a defined low score. Without labels of both kinds, or where a class
has too few rows to hold some back, the score is the share of toxic labels (0.0 without labels). Repeated rows each get their own
result; in the fit, a row repeated with its text counts once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from gustline.llm.arrow import annotate, strings
from gustline.storage import materialize

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Settings:
    toxic_rows: int = 2_000
    ordinary_rows: int = 6_000
    window: int = 16
    level: int = 6
    shared_bytes: int = 112_640
    #: Windows of ordinary texts that the shared part is trained on: those with the smallest hashes.
    trained_windows: int = 60_000
    #: Bytes of the own parts: as many as the toxic words need, between these.
    least_bytes: int = 1_024
    most_bytes: int = 16_384
    #: Texts that a word must be in before it can be overrepresented.
    support: int = 4


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    level: int
    window: int
    center: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    #: Calibrated difference from which a window counts as marked.
    limit: int
    prior: float
    #: Shares of ordinary windows that are marked, and that are strongly marked.
    rates: tuple[float, float] = (0.0, 0.0)
    #: Largest difference of an ordinary window.
    most: float = 0.0


FIELDS = ("mean", "marked", "strong", "beyond")


def _strong(limit: int) -> int:
    """Difference from which a window is strongly marked: more than one word's worth."""
    return 2 * limit + 4




def _windows(text: str, size: int) -> list[bytes]:
    words = text.lower().encode().split()
    return [b" ".join(words[i:i + size]) for i in range(0, len(words), size)] or [b""]


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    made.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False)


class Distance:
    """Differences of compressed lengths, per window: positive if the toxic dictionary fits better."""

    def __init__(self, toxic: bytes, ordinary: bytes, level: int):
        self.toxic, self.ordinary = _compressor(toxic, level).compress, _compressor(ordinary, level).compress

    def __call__(self, windows: list[bytes]) -> np.ndarray:
        toxic, ordinary = self.toxic, self.ordinary
        return np.fromiter((len(ordinary(w)) - len(toxic(w)) for w in windows), np.int64, len(windows))


def _excess(marked: np.ndarray | float, windows: np.ndarray | float, rate: float) -> np.ndarray:
    """Logarithm of the marked windows beyond those that ordinary text of this length has, three deviations above the mean: the
    length of a text by itself marks nothing."""
    expected = rate * windows
    return np.log1p(np.maximum(0.0, marked - expected - 3 * np.sqrt(expected)))


def _summary(d: np.ndarray, m: Model) -> tuple[float, ...]:
    return (float(d.mean()), float(_excess((d >= m.limit).sum(), len(d), m.rates[0])),
            float(_excess((d >= _strong(m.limit)).sum(), len(d), m.rates[1])), math.log1p(max(0.0, d.max() - m.most)))


_LIMITS = (2, 3, 4, 5, 6)


def _words(sample: DataFrame) -> DataFrame:
    """(word, ordinary, toxic): texts of either kind that a word is in, of the rows (y, text) not held back."""
    schema = StructType([StructField("word", BinaryType()), StructField("ordinary", LongType()), StructField("toxic", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for y, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                seen[y].update(set(_WORD.findall(text.lower().encode())))
            words = sorted(set(seen[0]) | set(seen[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), *[pa.array([n[w] for w in words], pa.int64()) for n in seen]], names=schema.names)

    return sample.select("y", "text").mapInArrow(run, schema).groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _overrepresented(words: DataFrame, own: str, other: str, rows: dict[str, int], support: int, size: int) -> list[bytes]:
    """Words at least twice as frequent per text in a class, by z-score, strongest last; as many as fill ``size`` bytes."""
    p = (F.col(own) + 0.5) / (rows[own] + 1)
    q = (F.col(other) + 0.5) / (rows[other] + 1)
    pool = (F.col(own) + F.col(other) + 0.5) / (rows[own] + rows[other] + 1)
    z = (p - q) / F.sqrt(pool * (1 - pool) * (1 / (rows[own] + 1) + 1 / (rows[other] + 1)))
    found = words.where((F.col(own) >= support) & (F.octet_length("word") >= 4)).withColumn("z", z).where((F.col("z") > 4) & (p > 2 * q))
    return [bytes(r["word"]) for r in found.orderBy(F.desc("z"), "word").limit(size // 5 + 1).collect()][::-1]


def _own_part(words: list[bytes], size: int) -> bytes:
    return b" ".join(words)[-size:].rjust(size, b"\0") + b" "


def _shared(windows: list[bytes], size: int) -> bytes:
    """zstandard's own training; too little text for it is used as it is."""
    try:
        return zstandard.train_dictionary(size, windows).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(windows)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps; the last weight is the constant."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _sample(df: DataFrame, labels: DataFrame, where: Column | None, s: Settings, key: str, text: str, label: str) -> DataFrame:
    """(y, part, text): at most the settings' rows of each class, those with the smallest hashed keys, each with its text once.
    Every third is held back (part 2)."""
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    marks = marks if where is None else marks.where(where)
    marks = marks.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("y")).withColumn("h", F.xxhash64("key"))
    most = {1: s.toxic_rows, 0: s.ordinary_rows}

    def first(rows: DataFrame, *order: str) -> DataFrame:
        """At most so many of each class; no more are sent to the tasks."""
        toxic, ordinary = (rows.where(F.col("y") == kind).orderBy(*order).limit(most[kind]) for kind in (1, 0))
        return materialize(toxic.union(ordinary), "chosen")

    # Keys first, then their rows, of which one key may have many: texts are not exchanged to find them.
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    keys = first(marks, "h", "key")
    names = first(rows.select("key", "t").join(F.broadcast(keys), "key").distinct(), "h", "key", "t")
    return materialize(rows.join(F.broadcast(names), ["key", "t"]).dropDuplicates(["key", "t"]).select(
        "y", F.pmod(F.xxhash64("h"), F.lit(3)).alias("part"), "text"), "sample")


def fit(df: DataFrame, labels: DataFrame, where: Column | None = None, settings: Settings = Settings(), key: str = "doc_id",
        text: str = "text", label: str = "toxic") -> Model:
    """A model from whole texts of the labelled rows for which ``where`` holds; at most the settings' rows of each class. Two of
    three rows make the dictionaries, the third calibrates. Of contradicting labels of a key the larger counts."""
    s = settings
    sample = _sample(df, labels, where, s, key, text, label)
    count = {(r["y"], r["back"]): r["count"] for r in sample.groupBy("y", (F.col("part") == 2).alias("back")).count().collect()}
    every = sum(count.values())
    prior = sum(n for (y, _), n in count.items() if y) / every if every else 0.0
    if len(count) < 4:
        return Model(b"", b"", s.level, s.window, (), (), (), 0, prior)
    made = sample.where("part <> 2")
    rows = {"ordinary": count[0, False], "toxic": count[1, False]}
    words = materialize(_words(made), "words")
    strong = _overrepresented(words, "toxic", "ordinary", rows, s.support, s.most_bytes)
    size = min(s.most_bytes, max(s.least_bytes, len(b" ".join(strong))))
    # Ordinary text has hardly any word of its own: rare words that tell nothing fill its part, so that both parts
    # help equally with any other word. Ordered by a hash of the word.
    rare = words.where(F.col("ordinary").between(3, 40) & (F.octet_length("word") >= 4)).orderBy(F.xxhash64("word"), "word").limit(size // 5 + 257)
    chosen = set(strong)
    fill = [w for w in (bytes(r["word"]) for r in rare.collect()) if w not in chosen]
    ordinary = fill + _overrepresented(words, "ordinary", "toxic", rows, s.support, size)

    def work():
        def run(texts: pa.Array) -> list[pa.Array]:
            return [pa.array([_windows(t, s.window) for t in strings(texts)], pa.list_(pa.binary()))]
        return run

    windows = annotate(made.where("y = 0"), work, StructType([StructField("w", ArrayType(BinaryType()))]), [], "text", 1 << 20)
    trained = windows.select(F.explode("w").alias("w")).orderBy(F.xxhash64("w"), "w").limit(s.trained_windows)
    shared = _shared([bytes(r["w"]) for r in trained.collect()], s.shared_bytes)
    parts = _own_part(strong, size) + shared, _own_part(ordinary, size) + shared

    def figures():
        distance = Distance(*parts, s.level)

        def run(texts: pa.Array) -> list[pa.Array]:
            found = [distance(_windows(t, s.window)) for t in strings(texts)]
            return [pa.array([float(d.mean()) for d in found]), pa.array([float(len(d)) for d in found]), pa.array([float(d.max()) for d in found]),
                    pa.array([[float((d >= x).sum()) for x in over] for d in found], pa.list_(pa.float64()))]
        return run

    over = [*_LIMITS, *map(_strong, _LIMITS)]
    kinds = StructType([StructField("mean", DoubleType()), StructField("windows", DoubleType()), StructField("largest", DoubleType()),
                        StructField("over", ArrayType(DoubleType()))])
    # At most the settings' rows, thirteen numbers each; sorted, as rows come in any order.
    got = sorted((r["y"], r["mean"], r["windows"], r["largest"], tuple(r["over"])) for r in annotate(sample.where("part = 2"), figures, kinds, ["y"], "text", 1 << 20).collect())
    y, mean, windows, largest = (np.array([r[i] for r in got], float) for i in range(4))
    marked = np.array([r[4] for r in got])
    most = float(largest[y == 0].max())
    beyond = np.log1p(np.maximum(0, largest - most))
    # Half a window more, as none of a few windows is not none of many.
    shares = (marked[y == 0].sum(0) + 0.5) / (windows[y == 0].sum() + 1)
    best = None
    for i, limit in enumerate(_LIMITS):
        rates = float(shares[i]), float(shares[i + len(_LIMITS)])
        x = np.column_stack([mean, _excess(marked[:, i], windows, rates[0]), _excess(marked[:, i + len(_LIMITS)], windows, rates[1]), beyond])
        center, scale = x.mean(0), x.std(0) + 1e-9
        w = _logistic((x - center) / scale, y)
        z = np.column_stack([(x - center) / scale, np.ones(len(x))]) @ w
        loss = float(np.logaddexp(0, np.where(y > 0, -z, z)).mean())
        if best is None or loss < best[0]:
            best = loss, limit, center, scale, w, rates
    _, limit, center, scale, w, rates = best
    return Model(*parts, s.level, s.window, tuple(center), tuple(scale), tuple(w), limit, prior, rates, most)


def score(df: DataFrame, model: Model, keep=("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, the probability ``score``, the number of windows and the three figures it is made of."""
    fields = StructType([StructField("score", DoubleType()), StructField("n_windows", LongType()),
                         *[StructField(f, DoubleType()) for f in FIELDS]])

    def work():
        distance = Distance(model.toxic, model.ordinary, model.level) if model.weights else None
        center, scale, w = map(np.array, (model.center, model.scale, model.weights))

        def run(texts: pa.Array) -> list[pa.Array]:
            windows = [_windows(t, model.window) for t in strings(texts)]
            if distance is None:
                x, p = np.zeros((len(windows), len(FIELDS))), np.full(len(windows), model.prior)
            else:
                x = np.array([_summary(distance(ws), model) for ws in windows]).reshape(-1, len(FIELDS))
                p = 1 / (1 + np.exp(-np.clip((x - center) / scale @ w[:-1] + w[-1], -30, 30)))
            return [pa.array(p), pa.array([len(ws) for ws in windows], pa.int64()), *[pa.array(x[:, i].copy()) for i in range(len(FIELDS))]]
        return run

    return annotate(df, work, fields, keep, text)
