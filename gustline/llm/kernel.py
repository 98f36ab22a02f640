"""Quality scores by kernel ridge regression on statistics of a document.

Random Fourier features: the cosines of random projections of the statistics have inner products near a Gaussian kernel, so a
ridge regression on them is near one in the kernel's space. Every task adds up the normal equations of its labelled rows; the
sums, of a fixed size, are solved on the driver. The ridge scores of labelled rows that were held back, counted on a fixed
grid, are made monotone by pooling neighbours (isotonic regression), which turns scores into probabilities.

All labelled rows are used; none is sampled. Features are rounded to whole numbers, so sums are exact and do not depend on how
rows are dealt out. Null and empty texts have statistics of zero and get a score like any other. Of contradicting labels of a
key the smaller counts. With labels of one kind only, every score is their share of ones (0.5 without any label). Repeated rows
each get their score; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from gustline.llm.arrow import WORD, annotate, col, hashes, spans, totals, utf8
from gustline.storage import materialize

STATISTICS = (
    "words", "word_size", "word_spread", "long_words", "short_words", "upper", "digits", "marks", "symbols", "other_bytes",
    "blanks", "upper_words", "symbol_words", "bare_words", "line_words", "repeated_lines", "distinct", "top_word",
    "repeated_pairs", "repeated_fives")

_UPPER, _DIGIT, _MARK, _SYMBOL = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[np.frombuffer(b".,;:!?'\"()-", np.uint8)] = True
_SYMBOL[np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass(frozen=True)
class Settings:
    features: int = 384
    #: Width of the kernel, in standard deviations of the statistics.
    width: float = 4.0
    ridge: float = 1e-4
    #: Statistics are cut at so many standard deviations.
    clip: float = 5.0
    #: One labelled row of so many is held back for the calibration.
    hold: int = 4
    grid: int = 4096
    #: What a row, and a prior of one row of each label, weighs in a step of the calibration.
    smooth: float = 0.5
    seed: int = 42


@dataclass(frozen=True)
class Model:
    center: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    #: Ridge scores and probabilities between which scores are interpolated.
    steps: tuple[np.ndarray, np.ndarray]
    clip: float
    prior: float


#: Features are rounded to parts of this, so that sums of products are exact in floating point.
_UNIT = 1 << 11


def _repeats(ids: np.ndarray, first: np.ndarray, wide: int) -> np.ndarray:
    """Per text, the share of runs of ``wide`` words that occurred before in it."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    until = np.repeat(first[1:], np.diff(first))
    i = np.flatnonzero(np.arange(len(ids)) + wide <= until)
    key = np.zeros(len(i), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(wide):
            key = (key ^ ids[i + k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    order = np.lexsort((key, text[i]))
    t, k = text[i][order], key[order]
    again = np.zeros(len(i), np.int64)
    again[1:] = (t[1:] == t[:-1]) & (k[1:] == k[:-1])
    n = len(first) - 1
    every = np.bincount(t, minlength=n)
    return np.bincount(t, weights=again, minlength=n) / np.maximum(every, 1)


def _most(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the number of distinct words and the occurrences of the most frequent one."""
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((ids, text))
    t, k = text[order], ids[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(t)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, t[at], size)
    return np.bincount(t[at], minlength=n), top


def describe(texts: pa.Array) -> np.ndarray:
    """The statistics of some texts, a row each."""
    data, at = utf8(texts)
    n = len(at) - 1
    begin, end, first = spans(data, at, WORD)
    size = (end - begin).astype(float)
    count = np.diff(first).astype(float)
    words, length = np.maximum(count, 1), np.maximum(np.diff(at), 1).astype(float)

    def share(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(kind[data])])
        return (sums[at[1:]] - sums[at[:-1]]) / length

    def having(kind: np.ndarray, least: int = 1) -> np.ndarray:
        """Per text, the share of words with so many bytes of the kind."""
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(kind[data])])
        return totals((sums[end] - sums[begin] >= least).astype(np.int64), first) / words

    line_begin, line_end, line_first = spans(data, at, np.arange(256) != 10)
    inside = np.searchsorted(begin, np.stack([line_begin, line_end]))
    full = inside[1] > inside[0]
    lines = totals(full.astype(np.int64), line_first)
    line_id = hashes(data, line_begin, line_end)
    kept = np.flatnonzero(full)
    kinds = _most(line_id[kept], np.searchsorted(kept, line_first))[0]
    ids = hashes(data, begin, end)
    distinct, top = _most(ids, first)
    mean = totals(size, first) / words
    spread = np.sqrt(np.maximum(totals(size ** 2, first) / words - mean ** 2, 0))
    columns = [
        np.log1p(count), mean, spread, totals((size > 12).astype(np.int64), first) / words,
        totals((size <= 3).astype(np.int64), first) / words, share(_UPPER), share(_DIGIT), share(_MARK), share(_SYMBOL),
        share(np.arange(256) >= 128), share(~WORD), having(_UPPER, 2), having(_SYMBOL), 1 - having(_LETTER),
        np.log1p(count / np.maximum(lines, 1)), (lines - kinds) / np.maximum(lines, 1), distinct / words, top / words,
        _repeats(ids, first, 2), _repeats(ids, first, 5)]
    out = np.column_stack(columns) if n else np.zeros((0, len(STATISTICS)))
    out[count == 0, 13] = 0
    return out


def statistics(df: DataFrame, keep=("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and the statistics of every row."""
    def work():
        def run(texts: pa.Array) -> list[pa.Array]:
            rows = describe(texts)
            return [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(STATISTICS))]
        return run

    return annotate(df, work, StructType([StructField(s, DoubleType()) for s in STATISTICS]), keep, text, 1 << 20)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(s).to_numpy() for s in STATISTICS])


def features(x: np.ndarray, m: Model) -> np.ndarray:
    """Random Fourier features, in whole numbers of 1 / ``_UNIT``; the last one is constant."""
    z = np.clip((x - m.center) / m.scale, -m.clip, m.clip)
    return np.column_stack([np.rint(np.cos(z @ m.turn + m.phase) * _UNIT), np.full(len(x), float(_UNIT))])


def _equations(rows: DataFrame, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and of z y over the rows (statistics and y), per task and then over the tasks."""
    size = len(m.phase) + 1
    upper = np.triu_indices(size)
    schema = StructType([StructField("slot", IntegerType()), StructField("v", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, right = np.zeros((size, size), np.int64), np.zeros(size, np.int64)
        for batch in batches:
            z = features(_matrix(batch), m)
            # A batch's products stay far below 2 ** 53, so these sums are exact.
            total += (z.T @ z).astype(np.int64)
            right += (z.T @ batch.column("y").to_numpy().astype(float)).astype(np.int64)
        if total[-1, -1]:
            values = np.concatenate([total[upper], right])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=schema.names)

    summed = rows.mapInArrow(run, schema).groupBy("slot").agg(F.sum("v").alias("v")).toPandas()  # a row per slot
    values = np.zeros(len(upper[0]) + size)
    values[summed["slot"].to_numpy()] = summed["v"].to_numpy()
    a = np.zeros((size, size))
    a[upper] = values[:-size] / _UNIT ** 2
    return a + np.triu(a, 1).T, values[-size:] / _UNIT


def _ridge(x: np.ndarray, m: Model) -> np.ndarray:
    return features(x, m) @ m.weights / _UNIT


def pooled(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Isotonic regression of the shares y / n in order: neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for ones, rows in zip(y.tolist(), n.tolist()):
        blocks.append([ones, rows, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            ones, rows, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + ones, blocks[-1][1] + rows, blocks[-1][2] + k]
    return np.concatenate([np.full(int(k), ones / rows) for ones, rows, k in blocks]) if blocks else np.zeros(0)


def _calibrated(rows: DataFrame, m: Model, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Scores and probabilities, from the counts of the rows on a grid over -0.5 to 1.5."""
    schema = StructType([StructField("cell", IntegerType()), StructField("y", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.clip((_ridge(_matrix(batch), m) + 0.5) / 2 * s.grid, 0, s.grid - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("y").cast(pa.int64())], names=schema.names)

    counted = rows.mapInArrow(run, schema).groupBy("cell").agg(
        F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).toPandas().sort_values("cell")  # at most a row per cell
    x = (counted["cell"].to_numpy() + 0.5) / s.grid * 2 - 0.5
    y, n = counted["y"].to_numpy().astype(float), counted["n"].to_numpy().astype(float)
    level = pooled(y, n)
    # Between two levels scores are interpolated; a level's rows keep it, drawn to even odds by a prior.
    cut = np.flatnonzero(np.append(True, level[1:] != level[:-1])) if len(level) else np.zeros(0, int)
    ends = np.append(cut[1:], len(level)) - 1 if len(level) else cut
    ones, every = (np.add.reduceat(v, cut) if len(cut) else v for v in (y, n))
    p = np.maximum.accumulate((ones + s.smooth) / (every + 2 * s.smooth)) if len(cut) else np.zeros(0)
    return np.column_stack([x[cut], x[ends]]).ravel(), np.repeat(p, 2)


def fit(stats: DataFrame, labels: DataFrame, where: Column | None = None, key: str = "doc_id", label: str = "quality",
        settings: Settings = Settings()) -> Model:
    """A model from the labelled rows of ``stats`` for which ``where`` (of the key) holds."""
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    marks = marks if where is None else marks.where(where)
    marks = marks.groupBy(key).agg(F.min(label).cast("int").alias("y"))
    rows = materialize(stats.join(marks, key).select(
        "y", *STATISTICS, (F.pmod(F.xxhash64(key), F.lit(settings.hold)) == 0).alias("held")), "labelled")
    seen = rows.agg(*[f(c) for c in STATISTICS for f in (F.avg, F.stddev_pop)], F.count(F.lit(1)), F.sum("y")).first()
    n, ones = seen[-2], seen[-1] or 0
    rng = np.random.default_rng(settings.seed)
    # Rounded, as the order in which doubles are added is not fixed.
    center = np.array([round(v or 0.0, 9) for v in seen[:-2:2]])
    scale = np.array([round(v or 0.0, 9) for v in seen[1:-2:2]])
    turn = rng.normal(0, 1 / settings.width, (len(STATISTICS), settings.features))
    phase = rng.uniform(0, 2 * np.pi, settings.features)
    none = np.zeros(0)
    model = Model(center, np.where(scale > 0, scale, 1.0), turn, phase, none, (none, none), settings.clip, ones / n if n else 0.5)
    if not 0 < ones < n:
        return model
    a, b = _equations(rows.where(~F.col("held")), model)
    penalty = settings.ridge * max(a[-1, -1], 1.0) * np.eye(len(b))
    penalty[-1, -1] = 1e-9
    model = Model(**{**model.__dict__, "weights": np.linalg.solve(a + penalty, b)})
    return Model(**{**model.__dict__, "steps": _calibrated(rows.where("held"), model, settings)})


def score(stats: DataFrame, model: Model, keep=("doc_id",)) -> DataFrame:
    """``keep`` and ``score``, the probability of label 1, from 0 to 1; ``ridge`` is the score before calibration."""
    schema = StructType([*[StructField(c, stats.schema[c].dataType) for c in keep], StructField("score", DoubleType()),
                         StructField("ridge", DoubleType())])
    names = schema.names
    x, p = model.steps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ridge = _ridge(_matrix(batch), model) if len(model.weights) else np.full(batch.num_rows, model.prior)
            # Without a row to calibrate on, the ridge score is all there is.
            out = np.interp(ridge, x, p) if len(x) else np.clip(ridge, 0, 1)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(out), pa.array(ridge)], names=names)

    return stats.select(*[col(c) for c in keep], *STATISTICS).mapInArrow(run, schema)
