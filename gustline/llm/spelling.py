"""Spelling variants: words one edit apart, found by a bit-sliced index of positions and letters.

A block of words is indexed by one bitset per (position, letter). A query word is followed letter by letter for all words of
the block at once, 64 to a machine word: one set holds the words without an error so far, one those with a replaced letter,
and one, on positions shifted by one, those with a letter more. Words a letter shorter follow by symmetry.

Which words must meet in a block is decided before, in Spark: two words one edit apart share the first or the last half of
the shorter one, so every word is filed under its halves, with words of its own length and one less. A group of more words
than a block holds is filed again by the halves of what is left, as often as needed; with one letter left a group is bounded by
the alphabet. Every pair is counted in one group only, however many it shares, so counts are added up and no pairs are kept.
Groups are packed into blocks of bounded size, so the work grows with the vocabulary.

Null texts have no words. A null key counts as the empty text. Repeated rows count again. Ties between equally frequent words
go to the smallest in code-point order. Without words the result has no rows. Very long words share blocks with few others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gustline.llm.arrow import col, pieces
from gustline.storage import materialize

#: Every how many-th (key, run) loses a letter, least code points and occurrences of a word, what a form needs.
LOSES, LEAST_SIZE, LEAST_N, TIMES = 97, 5, 3, 2
#: Words and letters of a block; queries followed at once.
BLOCK, LETTERS, QUERIES = 2048, 1 << 20, 512
#: Words that a task counts before it hands them on.
_HELD = 1 << 17

_RUN = re.compile("[a-zÀ-ÿ]+")
_COUNTED = StructType([StructField("word", StringType()), StructField("n", LongType())])
_NEAR = StructType([StructField("word", StringType()), StructField("n_near", LongType()), StructField("best_n", LongType()),
                    StructField("best", StringType())])


def runs(key: str, text: str) -> Counter:
    """The words of one text with their occurrences; the key decides which of them lose a letter."""
    # Bytes are lower-cased, as that leaves letters outside ASCII alone.
    found: Counter = Counter()
    begin = zlib.crc32(f"{key}:".encode())
    for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
        h = zlib.crc32(run.encode(), begin)
        if h % LOSES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        found[run] += n
    return found


def vocabulary(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_N, size: int = LEAST_SIZE) -> DataFrame:
    """(word, n) of the words long and frequent enough. Counts are combined in the tasks."""
    source = df.select(F.coalesce(col(key).cast("string"), F.lit("")).alias("k"), col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def packed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                             names=_COUNTED.names)
            held.clear()
            return out

        for batch in batches:
            for piece in pieces(batch, "t", 1 << 20):
                for k, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    for word, n in runs(k, t or "").items():
                        if len(word) >= size:
                            held[word] += n
                if len(held) > _HELD:
                    yield packed()
        yield packed()

    return source.mapInArrow(run, _COUNTED).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _filed(rows: DataFrame) -> DataFrame:
    """Every row under the front and under the back half of the ``c - left - right`` letters that are not shared yet."""
    rest = F.col("c") - F.col("left") - F.col("right")
    front = F.floor(rest / 2).cast("int")
    back = rest - front
    letters = F.expr("substring(word, left + 1, front)"), F.expr("substring(word, char_length(word) - right - back + 1, back)")
    kinds = [
        F.struct(F.xxhash64("g", F.lit(0), letters[0]).alias("g"), (F.col("left") + F.col("front")).alias("left"),
                 F.col("right").alias("right"), F.col("apart").alias("apart")),
        F.struct(F.xxhash64("g", F.lit(1), letters[1]).alias("g"), F.col("left").alias("left"),
                 (F.col("right") + F.col("back")).alias("right"),
                 F.concat("apart", F.array("left", "front")).alias("apart"))]
    return rows.withColumn("front", front).withColumn("back", back).select(
        "word", "n", "c", F.explode(F.array(*kinds)).alias("k")).select("word", "n", "c", "k.g", "k.left", "k.right", "k.apart")


def _first(words: DataFrame, least: int) -> DataFrame:
    """Every word with those of its length (c, the length of the shorter word) and with those one shorter."""
    size = F.char_length("word")
    classes = F.filter(F.array(size, size - 1), lambda c: c >= least)
    return words.select("word", "n", F.explode(classes).alias("c")).select(
        "word", "n", "c", F.col("c").cast("long").alias("g"), F.lit(0).alias("left"), F.lit(0).alias("right"),
        F.expr("cast(array() as array<int>)").alias("apart"))


def near_in_block(words: list[bytes], c: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of places of words one edit apart, a of ``c`` letters, b of ``c`` or ``c + 1``; words are in Latin-1."""
    n = len(words)
    wide = (n + 63) // 64
    matrix = np.frombuffer(b"".join(w.ljust(c + 2, b"\0") for w in words), np.uint8).reshape(n, c + 2)
    letters = np.unique(matrix)
    place = np.zeros(256, np.intp)
    place[letters] = np.arange(len(letters))

    def packed(bits: np.ndarray) -> np.ndarray:
        out = np.zeros((*bits.shape[:-1], wide * 8), np.uint8)
        out[..., :(n + 7) // 8] = np.packbits(bits, axis=-1, bitorder="little")
        return out.view(np.uint64)

    def index(position: int) -> np.ndarray:
        """A bitset of words per letter at the position."""
        return packed(matrix[:, position] == letters[:, None])

    size = np.array([len(w) for w in words])
    own, longer = packed(size == c), packed(size == c + 1)
    asked = np.flatnonzero(size == c)
    parts = [asked[i:i + QUERIES] for i in range(0, len(asked), QUERIES)]
    zero = [np.broadcast_to(own | longer, (len(q), wide)).copy() for q in parts]
    swap, more = [np.zeros_like(z) for z in zero], [np.zeros_like(z) for z in zero]
    here = index(0)
    for i in range(c):
        after = index(i + 1)
        for k, q in enumerate(parts):
            letter = place[matrix[q, i]]
            same = here[letter]
            more[k] |= zero[k]
            more[k] &= after[letter]
            swap[k] &= same
            swap[k] |= zero[k] & ~same
            zero[k] &= same
        here = after
    left, right = [], []
    for q, z, s, m in zip(parts, zero, swap, more):
        hit = (s & own) | ((m | z) & longer)
        rows = np.flatnonzero(hit.any(1))
        a, b = np.nonzero(np.unpackbits(hit[rows].view(np.uint8), axis=1, bitorder="little", count=n))
        left.append(q[rows[a]])
        right.append(b)
    none = np.zeros(0, np.intp)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _counted_here(a: bytes, b: bytes, left: int, right: int, apart: list[int]) -> bool:
    """Whether the pair shares what its group stands for, and belongs to no earlier group."""
    return a[:left] == b[:left] and a[len(a) - right:] == b[len(b) - right:] and all(
        a[i:i + k] != b[i:i + k] for i, k in zip(apart[::2], apart[1::2]))


def _summed(rows: pa.Table, groups: np.ndarray, c: int) -> pa.RecordBatch:
    """Per word of a block: near words, and the most frequent of them. Rows are in the order of words within a group."""
    names = rows["word"].to_pylist()
    words = [w.encode("latin-1") for w in names]
    n = rows["n"].to_numpy()
    a, b = near_in_block(words, c)
    met = groups[a] == groups[b]
    a, b = a[met], b[met]
    left, right = rows["left"].to_numpy()[a], rows["right"].to_numpy()[a]
    apart = dict(zip(*(lambda x: (x.tolist(), rows["apart"].take(pa.array(x)).to_pylist()))(np.unique(a))))
    here = np.fromiter((_counted_here(words[i], words[j], x, y, apart[i])
                        for i, j, x, y in zip(a.tolist(), b.tolist(), left.tolist(), right.tolist())), np.bool_, len(a))
    a, b = a[here], b[here]
    # A pair of equal lengths is found from both sides, one of unequal lengths from the shorter.
    size = np.array([len(w) for w in words])
    other = size[a] != size[b]
    u, v = np.concatenate([a, b[other]]), np.concatenate([b, a[other]])
    order = np.lexsort((v, -n[v], u))
    u, v = u[order], v[order]
    at, begin, times = np.unique(u, return_index=True, return_counts=True)
    best = v[begin]
    return pa.RecordBatch.from_arrays(
        [pa.array([names[i] for i in at.tolist()], pa.string()), pa.array(times.astype(np.int64)), pa.array(n[best].astype(np.int64)),
         pa.array([names[i] for i in best.tolist()], pa.string())], names=_NEAR.names)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, int]]:
    """Whole groups, packed: rows, the number of each row's group, and c. Groups of one word are left out."""
    held: pa.Table | None = None

    def cut(table: pa.Table, last: bool) -> Iterator[tuple[pa.Table, np.ndarray, int]]:
        nonlocal held
        keys = np.column_stack([table[x].to_numpy() for x in ("c", "left", "right", "g")])
        begin = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))), len(keys))
        if not last:
            held = table.slice(int(begin[-2]))
            begin = begin[:-1]
        size = np.diff(begin)
        some = size > 1
        begin, size = begin[:-1][some], size[some]
        kind = keys[begin, 0]
        i = 0
        while i < len(begin):
            most = max(2, min(BLOCK, LETTERS // (int(kind[i]) + 1)))
            j = i + 1
            total = int(size[i])
            while j < len(begin) and kind[j] == kind[i] and total + size[j] <= most:
                total += int(size[j])
                j += 1
            rows = np.concatenate([np.arange(b, b + s) for b, s in zip(begin[i:j].tolist(), size[i:j].tolist())])
            yield table.take(pa.array(rows)), np.repeat(np.arange(j - i), size[i:j]), int(kind[i])
            i = j

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
            held = None
        if table.num_rows:
            yield from cut(table, False)
    if held is not None and held.num_rows:
        yield from cut(held, True)


def _counts(filed: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, groups, c in _blocks(batches):
            yield _summed(rows, groups, c)

    return filed.repartition("g").sortWithinPartitions("c", "left", "right", "g", "word").mapInArrow(run, _NEAR)


def near(words: DataFrame, block: int = BLOCK, letters: int = LETTERS, least: int = LEAST_SIZE) -> DataFrame:
    """(word, n, n_near, best_n, best) of every word of the written table ``words`` (word, n): how many are one edit apart, and
    the most frequent of those."""
    parts = [words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                          F.lit(None).cast("string").alias("best"))]
    rows = _first(words, least)
    while True:
        filed = _filed(rows)
        # With a letter left, a group is as small as it gets.
        large = (F.col("size") > block) | (F.col("letters") > letters)
        busy = materialize(filed.where("c - left - right > 1").groupBy("g").agg(
            F.count(F.lit(1)).alias("size"), F.sum(F.char_length("word")).alias("letters")).where(large).select("g"), "busy")
        none = busy.isEmpty()
        cold = filed if none else filed.join(busy, "g", "left_anti")
        parts.append(_counts(cold).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best"))
        if none:
            break
        rows = materialize(filed.join(busy, "g", "left_semi").where("c - left - right > 1"), "large")
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    return every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, from (word, form). Each turn doubles the steps taken; as a form is at least twice
    as frequent as its word, six turns take 64 steps, and no count needs more. The driver sees one boolean a turn."""
    now = materialize(forms.where("form is not null").select("word", F.col("form").alias("root")), "steps")
    while True:
        after = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        now = materialize(now.join(after, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "steps")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(df: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the texts."""
    words = materialize(vocabulary(df, key, text), "words")
    much = F.col("best_n") >= TIMES * F.col("n")
    found = materialize(near(words, **settings).select("word", "n", "n_near", F.when(much, F.col("best")).alias("form"),
                                                       F.when(much, F.col("best_n")).alias("form_n")), "forms")
    return found.join(roots(found), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
