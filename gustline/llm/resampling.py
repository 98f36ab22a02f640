"""Importance resampling towards a target corpus, over hashed word n-grams.

A feature is a run of one to three words, its bucket the crc32 of its bytes. Texts are brought to one separator between words
and read once, storing the running CRC; the CRC of any run then follows from the two CRCs at its ends: CRC is linear over
GF(2), so the first one, shifted by the run's length, cancels out of the second one. Shifts are products with a matrix, four
table look-ups a value for short runs and one more step per binary digit of the length beyond.

Bucket counts of source and target have a fixed size. Weights are sums of integer gains, noise is drawn from the key, and the
largest sums are drawn: keys that are drawn do not depend on how rows lie. Ranks come from the place in a range partition and
the sizes of the partitions before it; no task holds all drawn rows, and only drawn rows are sorted.

Null and empty texts have no features and weight 0. A null key counts as the empty text and comes last among equal scores;
repeated rows each count and are drawn each. Without documents the result is empty; without a target all gains follow from
the source alone. Very long texts are read in pieces of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from gustline.llm.arrow import ALNUM, LOWER, annotate, col, pieces, spans, totals, utf8
from gustline.storage import materialize

#: Buckets, words of the longest run, least words and drawn percentage, and the seed of the noise.
BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: Fixed value: the reflected polynomial of CRC-32.
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)
#: Bytes of text worked on at once, and bytes of a row of the scan.
_PIECE, _ROW = 1 << 20, 256


def _byte_table() -> np.ndarray:
    """What a byte adds to the register."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), t >> np.uint32(1))
    return t


_TABLE = _byte_table()


def _product(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The linear map with these four tables (by byte of the register)."""
    return tables[0][x & 255] ^ tables[1][x >> 8 & 255] ^ tables[2][x >> 16 & 255] ^ tables[3][x >> 24]


@lru_cache(maxsize=1)
def _short() -> np.ndarray:
    """Tables of the shifts by 0 to 255 zero bytes: (shift, byte of the register, value)."""
    out = np.empty((_ROW, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, _ROW):
        out[n] = _TABLE[out[n - 1] & np.uint32(255)] ^ (out[n - 1] >> np.uint32(8))
    return out


@lru_cache(maxsize=64)
def _doubled(k: int) -> np.ndarray:
    """Tables of the shift by 256 * 2 ** k bytes."""
    if k:
        half = _doubled(k - 1)
        return _product(half, half)
    last = _short()[_ROW - 1]
    return _TABLE[last & np.uint32(255)] ^ (last >> np.uint32(8))


def shifted(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Registers after as many more zero bytes."""
    t, low = _short().reshape(-1), (size % _ROW) << 10
    out = t[low + (x & 255)] ^ t[low + 256 + (x >> 8 & 255)] ^ t[low + 512 + (x >> 16 & 255)] ^ t[low + 768 + (x >> 24)]
    rest, k = size // _ROW, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = _product(_doubled(k), out[odd])
        rest, k = rest >> 1, k + 1
    return out


class Running:
    """The register (from 0) after every byte of a stream. Rows of 256 bytes are read side by side; a row's own beginning is
    added when a value is asked for."""

    def __init__(self, stream: np.ndarray):
        rows = max(1, -(-(len(stream) + 1) // _ROW))
        lanes = np.zeros((rows, _ROW), np.uint8)
        lanes.reshape(-1)[:len(stream)] = stream
        lanes = np.ascontiguousarray(lanes.T)
        self.inside = np.zeros((_ROW + 1, rows), np.uint32)
        for j in range(_ROW):
            now = self.inside[j]
            self.inside[j + 1] = _TABLE[(now ^ lanes[j]) & np.uint32(255)] ^ (now >> np.uint32(8))
        # Registers at the ends of rows, each with those of the rows before: 1, 2, 4, ... rows at a time.
        ends, k = self.inside[_ROW].copy(), 0
        while 1 << k < rows:
            ends[1 << k:] ^= _product(_doubled(k), ends[:-(1 << k)])
            k += 1
        self.begin = np.concatenate([np.zeros(1, np.uint32), ends[:-1]])

    def at(self, place: np.ndarray) -> np.ndarray:
        row, j = place // _ROW, place % _ROW
        return self.inside[j, row] ^ shifted(self.begin[row], j)


def normalised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts with a blank after each, as one stream; where each word begins and ends in it; and the first
    word of every text."""
    data, at = utf8(texts)
    low = LOWER[data]
    begin, end, first = spans(low, at, ALNUM)
    size = end - begin
    start = np.cumsum(size + 1) - (size + 1)
    stream = np.full(int((size + 1).sum()), 32, np.uint8)
    letters = np.ones(len(stream), bool)
    letters[start + size] = False
    stream[letters] = low[ALNUM[low]]
    return stream, start, start + size, first


def buckets(texts: pa.Array, longest: int = LONGEST) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per run length, the first word and the bucket of every run; and the first word of every text."""
    stream, begin, end, first = normalised(texts)
    running = Running(stream)
    before, after = running.at(begin) ^ _ONES, running.at(end)
    until = np.repeat(first[1:], np.diff(first))
    words, found = [], []
    for n in range(1, longest + 1):
        i = np.flatnonzero(np.arange(len(begin)) + n <= until)
        last = i + n - 1
        crc = after[last] ^ shifted(before[i], end[last] - begin[i]) ^ _ONES
        words.append(i)
        found.append((crc % np.uint32(BUCKETS)).astype(np.int64))
    return words, found, first


def histogram(df: DataFrame, text: str = "text") -> np.ndarray:
    """Features per bucket over all rows, as an array of fixed size. Counts are combined in the tasks."""
    schema = StructType([StructField("bucket", IntegerType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for piece in pieces(batch, "t", _PIECE):
                for found in buckets(piece.column(0))[1]:
                    n += np.bincount(found, minlength=BUCKETS)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some])], names=schema.names)

    counted = df.select(col(text).cast("string").alias("t")).mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counted.collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of a nat that a feature of the bucket speaks for the target."""
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(df: DataFrame, gain: np.ndarray, keep=None, text: str = "text") -> DataFrame:
    """``keep`` (all columns unless given), n_words, n_features and weight of every row."""
    fields = StructType([StructField(c, LongType()) for c in ("n_words", "n_features", "weight")])
    gain = np.asarray(gain, np.int64)

    def work():
        def run(texts: pa.Array) -> list[pa.Array]:
            words, found, first = buckets(texts)
            per, more = np.zeros(int(first[-1]), np.int64), np.zeros(int(first[-1]), np.int64)
            for i, b in zip(words, found):
                per[i] += 1
                more[i] += gain[b]
            return [pa.array(np.diff(first).astype(np.int64)), pa.array(totals(per, first)), pa.array(totals(more, first))]
        return run

    return annotate(df, work, fields, keep, text, _PIECE)


def noise(key: str, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel draw, from the seed and the key."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, key: str, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """``scored`` (key, n_words, score, and more) with ``rank``: 1, 2, 3... for the drawn rows, null for the others."""
    rows = materialize(scored.withColumn("__row", F.monotonically_increasing_id()), "scored")
    able = F.coalesce(F.col("n_words") >= least, F.lit(False))
    n, cut = rows.where(able).agg(
        F.count(F.lit(1)), F.percentile_approx("score", max(0.0, 0.99 - percent / 100), F.lit(10_000))).first()
    most = percent * n // 100
    undrawn = F.lit(None).cast("long")
    if not most:
        return rows.withColumn("rank", undrawn).drop("__row")
    # At least the drawn rows have this score: the cut is a hundredth of the rows lower, its error a ten-thousandth.
    order = [F.col("score").desc(), col(key).asc_nulls_last(), F.col("__row").asc()]
    spread = rows.where(able & (F.col("score") >= cut)).repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of a row in its partition and the partition's number, as one.
    top = materialize(spread.withColumn("__place", F.monotonically_increasing_id()), "top")
    part, within = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r[0]: r[1] for r in top.groupBy(part.alias("part")).count().collect()}  # one row a partition
    before, begin = [], 0
    for p in range(max(sizes) + 1):
        before.append(begin)
        begin += sizes.get(p, 0)
    offset = F.element_at(F.lit(np.array(before, np.int64)).cast("array<bigint>"), (part + 1).cast("int"))
    ranked = top.withColumn("rank", offset + within + 1)
    drawn = ranked.where(F.col("rank") <= most)
    last = ranked.where(F.col("rank") == most).select("score", col(key).alias("k"), "__row").first()
    score, at, row = F.lit(last["score"]), F.lit(last["k"]), F.lit(last["__row"])
    same_key = col(key).eqNullSafe(at) & (F.col("__row") > row)
    later = F.when(at.isNull(), F.lit(False)).when(col(key).isNull(), F.lit(True)).otherwise(col(key) > at)
    after = (F.col("score") < score) | (F.col("score") == score) & (later | same_key)
    rest = rows.where(~able | after).withColumn("rank", undrawn)
    return drawn.drop("__place").unionByName(rest).drop("__row")


def resample(df: DataFrame, target: DataFrame, keep=("doc_id",), key: str = "doc_id", text: str = "text",
             target_text: str = "text", percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``keep`` (with the key among it), n_words, n_features, weight, score and rank of every row of ``df``."""
    gain = gains(histogram(df, text), histogram(target, target_text))
    weighed = weigh(df, gain, keep, text)
    return draw(weighed.withColumn("score", F.col("weight") + noise(key, seed)), key, percent, least)
