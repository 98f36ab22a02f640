"""Row-wise work on texts in Arrow batches, and words as numpy spans.

``annotate`` runs a function over the texts of a frame, piece by piece, so that a Python task holds a few megabytes of
text whatever the size of the table (one longer text is a piece of its own). There is no shuffle in it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PIECE_BYTES = 4 << 20
_CHUNK = 1 << 20

#: ``[^\\x20\\x09-\\x0D]`` by byte; every byte of a longer UTF-8 sequence is in it.
WORD = np.ones(256, np.bool_)
WORD[[9, 10, 11, 12, 13, 32]] = False
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` by byte, for text whose A-Z are lower-cased.
ALNUM = np.zeros(256, np.bool_)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of text; a longer text is a slice of its own."""
    at = batch.schema.get_field_index(column)
    sizes = np.diff(offsets(batch.column(at)))
    begin = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if batch.num_rows > begin:
        yield batch.slice(begin)


def _large(texts: pa.Array) -> pa.Array:
    return texts.cast(pa.large_binary()) if pa.types.is_binary(texts.type) else texts.cast(pa.large_string())


def offsets(texts: pa.Array) -> np.ndarray:
    big = _large(texts)
    if not len(big):
        return np.zeros(1, np.int64)
    return np.frombuffer(big.buffers()[1], np.int64)[big.offset:big.offset + len(big) + 1]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins and ends; null is empty."""
    big = _large(texts)
    if big.null_count:
        big = big.fill_null("" if pa.types.is_large_string(big.type) else b"")
    at = offsets(big)
    body = big.buffers()[2] if len(big) else None
    data = np.frombuffer(body, np.uint8)[at[0]:at[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def strings(texts: pa.Array) -> list[str]:
    """Python strings; null is empty."""
    return [t or "" for t in texts.to_pylist()]


def spans(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every run of ``kind`` bytes that stays inside a text, and the first run of each text."""
    inside = kind[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[:1] = False
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1:] = False
    edges = at[:-1][at[:-1] < len(data)]
    before[edges] = False
    edges = at[1:][at[1:] > 0] - 1
    after[edges] = False
    begin = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return begin, end, np.searchsorted(begin, at)


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        factor = np.full(size, 0x9E3779B97F4A7C15, np.uint64)
        inverse = np.full(size, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
        factor[0] = inverse[0] = 1
        return np.multiply.accumulate(factor), np.multiply.accumulate(inverse)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span (in order, not overlapping), by prefix sums over chunks that fit the cache."""
    out = np.empty(len(begin), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(begin):
            j = max(i + 1, int(np.searchsorted(end, begin[i] + _CHUNK, side="right")))
            low, size = int(begin[i]), int(end[j - 1] - begin[i])
            factor, inverse = _powers(max(_CHUNK, 1 << (size - 1).bit_length()))
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum((data[low:low + size].astype(np.uint64) + np.uint64(1)) * factor[:size], out=sums[1:])
            s, e = begin[i:j] - low, end[i:j] - low
            out[i:j] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
            i = j
    return mix(out)


def totals(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; ``first`` as given by ``spans``."""
    sums = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def annotate(df: DataFrame, work: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]], fields: StructType,
             keep: Sequence[str] | None = None, text: str = "text", limit: int = PIECE_BYTES) -> DataFrame:
    """``keep`` (all columns unless given) and the new ``fields`` of every row.

    ``work()`` is called once per task and gives the function from an array of texts to the new columns. A kept column
    whose name is that of a new one, in any case, gives way to it.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    schema = StructType([*[StructField(c, df.schema[c].dataType, True) for c in kept], *fields.fields])
    # A kept text goes to the tasks once.
    once = text in kept and isinstance(df.schema[text].dataType, StringType)
    place = kept.index(text) if once else len(kept)
    source = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(kept)], *([] if once else [col(text).cast("string").alias("t")]))
    names, column, many = [f.name for f in schema], source.columns[place], len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = work()
        for batch in batches:
            for piece in pieces(batch, column, limit):
                columns = piece.columns
                yield pa.RecordBatch.from_arrays([*columns[:many], *made(columns[place])], names=names)

    return source.mapInArrow(run, schema)
