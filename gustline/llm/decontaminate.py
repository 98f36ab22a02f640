"""Benchmark decontamination by winnowing.

A benchmark item is a set of word windows of ``window`` words (an item with fewer, but some, is one window). Both sides are
cut into k-grams of words; of every run of consecutive k-grams only the smallest hash is kept, so any shared span of
``window`` words has a common fingerprint at the same place. Fingerprints are matched, each match is extended word by word
in both directions, and the words of a shared span that holds a whole window are hit. Extension compares the words
themselves, so results are exact. Items shorter than the window have fingerprints of their own length, all of them kept.

Fingerprints of both sides are joined by Spark, which sends the items' ones to the tasks only if they are small. A filter of
fixed size, made from the items' hashes, keeps most other fingerprints of documents from being exchanged at all. Pairs of
a text and an item that share a fingerprint are then extended, a bounded number of items of a text at a time; copies of a
text are one text here, and texts without a shared fingerprint are never exchanged. Null and empty texts have no words and
no hits. Repeated documents each get their own result; repeated items count once per item_id. An item whose id is null
takes part in hits but not in the items.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gustline.llm.arrow import ALNUM, LOWER, annotate, col, hashes, mix, pieces, spans, utf8
from gustline.storage import materialize

WINDOW, GRAM = 10, 5
#: Bits of the filter that is sent to the tasks: 8 MB.
FILTER_BITS = 1 << 26
#: Items that are held against a text at a time.
TOGETHER = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive words."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:n].copy()
        for i in range(1, k):
            out = out * _STEP + words[i:i + n]
    return mix(out)


def winnow(values: np.ndarray, width: int, breaks: np.ndarray | None = None) -> np.ndarray:
    """Places that hold the smallest value of some ``width`` consecutive ones. Of equal values the last counts.

    ``breaks``: begins of texts in ``values`` that windows must not cross; a text with fewer values than ``width`` keeps
    the smallest of all it has.
    """
    n = len(values)
    if not n:
        return np.zeros(0, np.int64)
    # Smallest of [i, i + width), by doubling; places across a break only add fingerprints, they never lose one.
    best = np.arange(n)
    reach = 1
    while reach < width and reach < n:
        step = min(reach, width - reach)
        other = np.concatenate([best[step:], np.full(min(step, n), n - 1)])[:n]
        better = values[other] <= values[best]
        tail = np.arange(n) + step > n - 1
        best = np.where(better & ~tail, other, best)
        reach += step
    if breaks is None or len(breaks) < 2:
        return np.unique(best[:max(1, n - width + 1)])
    # A window that crosses a break may have its smallest value beyond it: windows are taken per text there.
    place = np.zeros(n, np.int64)
    place[breaks[breaks < n]] = 1
    text = np.cumsum(place)
    whole = np.arange(n) + width <= n
    whole[whole] = text[np.flatnonzero(whole)] == text[np.flatnonzero(whole) + width - 1]
    kept = [best[whole]]
    sizes = np.diff(np.append(breaks, n))
    for i in np.flatnonzero((sizes > 0) & (sizes < width)).tolist():
        a, b = int(breaks[i]), int(breaks[i] + sizes[i])
        kept.append(np.array([b - 1 - int(np.argmin(values[a:b][::-1]))]))
    return np.unique(np.concatenate(kept))


def _fingerprints(words: np.ndarray, window: int, gram: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Kind, hashes and places of an item's fingerprints. Kind: ``gram``, or less than 0 for an item of fewer words than
    the window, which is one k-gram as a whole."""
    if len(words) >= window:
        h = grams(words, gram)
        at = winnow(h, window - gram + 1)
        return gram, h[at], at
    return -len(words), grams(words, len(words)), np.zeros(1, np.int64)


def _document_prints(words: np.ndarray, first: np.ndarray, kind: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints of one kind, one text after another in ``words``; of items shorter than the
    window every place is one. K-grams that cross two texts may be among them."""
    h = grams(words, abs(kind))
    if kind < 0:
        return np.arange(len(h)), h
    # Fingerprints of each text on its own: a text of n words has its n-k+1 first places of these.
    n = len(h)
    breaks = np.unique(first[:-1][first[:-1] < n])
    # K-grams that cross a text's end must not hide others: they get the largest value.
    sizes = np.diff(first)
    cross = np.zeros(n, bool)
    for back in range(1, kind):
        p = first[1:][(sizes > 0)] - back
        cross[p[(p >= 0) & (p < n)]] = True
    h = np.where(cross, np.uint64(0xFFFFFFFFFFFFFFFF), h)
    at = winnow(h, window - kind + 1, breaks)
    return at, h[at]


class Index:
    """Fingerprints of a few items."""

    def __init__(self, ids: list, texts: list[str], window: int, gram: int):
        data, at = utf8(pa.array(texts, pa.large_string()))
        self.ids, self.window, self.gram = ids, window, gram
        data = LOWER[data]
        begin, end, first = spans(data, at, ALNUM)
        words = hashes(data, begin, end)
        raw = data.tobytes()
        self.words = [raw[b:e] for b, e in zip(begin.tolist(), end.tolist())]
        self.first = first.tolist()
        rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # kind -> (hash, item, place)
        for i in range(len(ids)):
            a, b = self.first[i], self.first[i + 1]
            if a < b:
                kind, h, places = _fingerprints(words[a:b], window, gram)
                rows[kind] += [(int(x), i, int(p)) for x, p in zip(h, places)]
        self.tables = {}
        for kind, found in rows.items():
            found.sort()
            keys, starts = np.unique(np.array([f[0] for f in found], np.uint64), return_index=True)
            self.tables[kind] = keys, np.append(starts, len(found)).tolist(), [(f[1], f[2]) for f in found]

    def matches(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place in the documents' words, item, place in the item) of equal fingerprints."""
        for kind, (keys, starts, found) in self.tables.items():
            at, h = _document_prints(words, first, kind, self.window)
            slot = np.searchsorted(keys, h)
            slot[slot == len(keys)] = 0
            for place, s in zip(*[x[keys[slot] == h].tolist() for x in (at, slot)]):
                for item, inside in found[starts[s]:starts[s + 1]]:
                    yield place, item, inside


def _hits(index: Index, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set]]:
    """Words of each text, its shared spans as (begin, end) words, and the items found in it."""
    data = LOWER[data]
    begin, end, first = spans(data, at, ALNUM)
    found: list[list[tuple[int, int]]] = [[] for _ in range(len(at) - 1)]
    items: list[set] = [set() for _ in range(len(at) - 1)]
    if len(begin) and index.tables:
        words = hashes(data, begin, end)
        raw = data.tobytes()
        first_list = first.tolist()
        done: dict[tuple[int, int, int], int] = {}  # (text, item, diagonal) -> end of the last span looked at

        def word(i: int) -> bytes:
            return raw[begin[i]:end[i]]

        near: list[tuple[int, int, int]] = sorted(index.matches(words, first))
        texts = np.searchsorted(first, [m[0] for m in near], side="right") - 1 if near else []
        for (place, item, inside), text in zip(near, texts):
            text = int(text)
            low, high = first_list[text], first_list[text + 1]
            a, b = index.first[item], index.first[item + 1]
            if done.get((text, item, place - inside), -1) > place:
                continue
            # Extend from the place itself to both sides while the words are equal.
            i, j = place, a + inside
            while i > low and j > a and word(i - 1) == index.words[j - 1]:
                i, j = i - 1, j - 1
            p, q = place, a + inside
            while p < high and q < b and word(p) == index.words[q]:
                p, q = p + 1, q + 1
            done[text, item, place - inside] = max(p, place + 1)
            if p - i >= min(index.window, b - a):
                found[text].append((i - low, p - low))
                items[text].add(index.ids[item])
    return np.diff(first), found, items


def _merged(spans_: list) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans_)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _joined(h: np.ndarray, kind: int) -> np.ndarray:
    """One value of hash and kind, as a signed long."""
    with np.errstate(over="ignore"):
        return mix(h + np.uint64(kind % (1 << 64)) * _STEP).view(np.int64)


def _item_prints(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(item, kind, hash) of distinct item texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "t"):
                data, at = utf8(piece.column(1))
                data = LOWER[data]
                begin, end, first = spans(data, at, ALNUM)
                words = hashes(data, begin, end)
                rows, kinds, values = [], [], []
                for i in np.flatnonzero(np.diff(first)).tolist():
                    kind, h, _ = _fingerprints(words[first[i]:first[i + 1]], window, gram)
                    h = np.unique(_joined(h, kind))
                    rows.append(np.full(len(h), i))
                    kinds.append(np.full(len(h), kind, np.int32))
                    values.append(h)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(kinds)),
                         pa.array(np.concatenate(values))], names=["item", "kind", "hash"])

    return texts.select("item", "t").mapInArrow(run, "item string, kind int, hash bigint")


def _filter(prints: DataFrame) -> np.ndarray:
    """``FILTER_BITS`` bits, set where a hash of the items begins with that number: of fixed size whatever the items."""
    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS.bit_length() + 1)
    marked = prints.select(slot.alias("s")).select(
        F.shiftright("s", 6).alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("m"))
    found = marked.groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[found["w"].to_numpy(np.int64)] = found["m"].to_numpy(np.int64).view(np.uint64)
    return bits


def _text_prints(source: DataFrame, kinds: list[int], bits, window: int) -> DataFrame:
    """(digest, hash) of the fingerprints of texts ``t`` that pass the filter, once per text."""
    shift = np.uint64(64 - FILTER_BITS.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value
        for batch in batches:
            for piece in pieces(batch, "t"):
                data, at = utf8(piece.column(1))
                data = LOWER[data]
                begin, end, first = spans(data, at, ALNUM)
                words = hashes(data, begin, end)
                for kind in kinds:
                    place, h = _document_prints(words, first, kind, window)
                    h = _joined(h, kind)
                    slot = h.view(np.uint64) >> shift
                    hit = (known[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
                    if not hit.any():
                        continue
                    text = np.searchsorted(first, place[hit], side="right") - 1
                    found = np.unique(np.stack([text, h[hit]]), axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).take(pa.array(found[0])), pa.array(found[1])], names=["d", "hash"])

    return source.mapInArrow(run, "d string, hash bigint")


_EXTENDED = "d string, spans array<array<int>>, items array<string>"


def _extend(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([], [], [])
            for i in range(batch.num_rows):
                few = batch.column(2)[i].as_py()
                data, at = utf8(batch.column(1).slice(i, 1))
                _, found, seen = _hits(Index([x["item"] for x in few], [x["t"] for x in few], window, gram), data, at)
                if found[0]:
                    for out, value in zip(rows, (i, _merged(found[0]), sorted(seen[0]))):
                        out.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.list_(pa.list_(pa.int32()))),
                 pa.array(rows[2], pa.list_(pa.string()))], names=["d", "spans", "items"])
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        merged = pa.array([_merged(s) for s in batch.column(1).to_pylist()], pa.list_(pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays([batch.column(0), merged], names=["d", "hits"])


def _digest(text: str):
    """Equal texts have equal fingerprints and hits: they are told apart by nothing else."""
    return F.md5(col(text).cast("string"))


def shared_spans(df: DataFrame, items: DataFrame, text: str = "text", key: str = "item_id", window: int = WINDOW,
                 gram: int = GRAM, together: int = TOGETHER) -> DataFrame:
    """(d, hits, items) of each distinct text, by its digest, that holds a window of an item: merged spans of hit words
    and the sorted ids. Written."""
    context = df.sparkSession.sparkContext
    known = items.where(col(text).isNotNull()).select(
        _digest(text).alias("item"), col(key).cast("string").alias("id"), col(text).cast("string").alias("t"))
    texts = materialize(known.groupBy("item").agg(F.first("t").alias("t")), "items")
    prints = materialize(_item_prints(texts, window, gram), "item_prints")
    # At most as many kinds as the window has words.
    kinds = sorted(r["kind"] for r in prints.select("kind").distinct().collect())
    source = df.where(col(text).isNotNull()).select(_digest(text).alias("d"), col(text).cast("string").alias("t"))
    mine = _text_prints(source, kinds, context.broadcast(_filter(prints)), window)
    pairs = materialize(mine.join(prints.select("hash", "item"), "hash").select("d", "item").distinct(), "pairs")
    # Copies are one text; only texts that share a fingerprint are exchanged.
    bodies = source.join(pairs.select("d"), "d", "left_semi").groupBy("d").agg(F.first("t").alias("t"))
    parts = pairs.groupBy("d").agg(F.ceil(F.count(F.lit(1)) / together).alias("parts"))
    part = F.pmod(F.xxhash64("item"), F.col("parts"))
    packed = pairs.join(parts, "d").join(texts, "item").groupBy("d", part.alias("part")).agg(
        F.collect_list(F.struct("item", "t")).alias("few"))
    extended = materialize(packed.join(bodies, "d").select("d", "t", "few").mapInArrow(_extend(window, gram), _EXTENDED), "extended")
    hits = extended.groupBy("d").agg(F.flatten(F.collect_list("spans")).alias("spans")).mapInArrow(
        _merge, "d string, hits array<array<int>>")
    ids = extended.select("d", F.explode("items").alias("item")).join(known.select("item", "id").distinct(), "item")
    named = ids.groupBy("d").agg(F.array_sort(F.collect_set("id")).alias("items"))
    return materialize(hits.join(named, "d", "left").select("d", "hits", F.coalesce("items", F.array().cast("array<string>")).alias("items")), "hits")


def contaminate(df: DataFrame, items: DataFrame, keep=None, text: str = "text", key: str = "item_id", window: int = WINDOW,
                gram: int = GRAM, together: int = TOGETHER) -> DataFrame:
    """``keep`` (all columns unless given) with n_words, n_hit, n_items, ``items`` (sorted as strings) and ``hits``, the
    merged spans of hit words as begin and end."""
    new = {"n_words", "n_hit", "n_items", "items", "hits"}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    source = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(kept)], _digest(text).alias("d"), col(text).alias("t"))

    def work():
        def run(texts: pa.Array) -> list[pa.Array]:
            data, at = utf8(texts)
            return [pa.array(np.diff(spans(LOWER[data], at, ALNUM)[2]), pa.int64())]
        return run

    counted = annotate(source, work, StructType([StructField("n_words", LongType())]),
                       [*[f"k{i}" for i in range(len(kept))], "d"], "t")
    found = counted.join(shared_spans(df, items, text, key, window, gram, together), "d", "left")
    hits, ids = F.coalesce("hits", F.array().cast("array<array<int>>")), F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.aggregate(hits, F.lit(0).cast("bigint"), lambda total, s: total + s[1] - s[0])
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], "n_words", n_hit.alias("n_hit"),
                        F.size(ids).cast("bigint").alias("n_items"), ids.alias("items"), hits.alias("hits"))


def clean(df: DataFrame, items: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The rows without a hit, with the columns they had."""
    hit = shared_spans(df, items, text, **settings).select("d")
    numbered = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(df.columns)], _digest(text).alias("d"))
    return numbered.join(hit, "d", "left_anti").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(df.columns)])
