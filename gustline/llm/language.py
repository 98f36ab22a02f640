"""Language identification of mixed text: scripts narrow the candidates, Viterbi labels the spans.

Each word is scored by its byte trigrams (with the blanks around it) under every language; the table of scores has a fixed
size and is counted over all labelled texts. A word's script, from code point ranges, leaves only the languages that are
written in it. The best path over the words of a text, with a penalty for every switch of language, labels spans; the
language with the most letters is the text's.

There is no limit to the number of languages. The model has the seen buckets of each; of many languages, a task scores
blocks of words by blocks of languages and keeps one bit per word and language for the way back.

Counts are combined in the tasks, so the exchange carries (language, bucket) rows only. Null, empty and letterless texts are
``und`` with score 0. Without labelled texts every text is ``und``. Ties go to the first language by name. Repeated rows
each get their own result; labels are compared as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from gustline.llm.arrow import WORD, annotate, col, pieces, spans, utf8
from gustline.storage import materialize

BUCKETS = 1 << 16
#: What a switch of language costs, in nats.
SWITCH = 8.0
#: Share of a language's letters that a script needs to be one of the language's scripts.
SCRIPT_SHARE = 0.01
#: Languages whose scores a task holds as a table; of more, tables of ``_SOME`` languages are made in turn.
_HELD, _SOME = 256, 64
#: Words times languages that are scored at once, and bytes of text worked on at once: a byte takes some dozens in the process.
_CELLS = 1 << 23
_PIECE = 1 << 20

#: First code points of ranges, and the script of each (0: no letters).
_RANGES = (
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0), (0x00B5, 1), (0x00B6, 0),
    (0x00BA, 1), (0x00BB, 0), (0x00C0, 1), (0x00D7, 0), (0x00D8, 1), (0x00F7, 0), (0x00F8, 1), (0x02B9, 0), (0x0370, 2),
    (0x0400, 3), (0x0531, 4), (0x0591, 5), (0x0600, 6), (0x0700, 7), (0x0900, 8), (0x0980, 9), (0x0A00, 10), (0x0A80, 11),
    (0x0B00, 12), (0x0B80, 13), (0x0C00, 14), (0x0C80, 15), (0x0D00, 16), (0x0D80, 17), (0x0E00, 18), (0x0E80, 19),
    (0x0F00, 20), (0x1000, 21), (0x10A0, 22), (0x1100, 23), (0x1200, 24), (0x13A0, 7), (0x1780, 25), (0x1800, 26),
    (0x18B0, 7), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C00, 7), (0x2E80, 27), (0x3000, 0), (0x3041, 28), (0x3100, 27),
    (0x3130, 23), (0x3190, 27), (0x31F0, 28), (0x3200, 0), (0x3400, 27), (0xA000, 7), (0xAC00, 23), (0xD7B0, 7),
    (0xF900, 27), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 0), (0xFF21, 1), (0xFF3B, 0),
    (0xFF41, 1), (0xFF5B, 0), (0xFF66, 28), (0xFFA0, 23), (0xFFE0, 0), (0x10000, 7), (0x1F000, 0), (0x20000, 27),
    (0x30000, 0))
SCRIPTS = 29
_FROM = np.array([r[0] for r in _RANGES])
_SCRIPT = np.array([r[1] for r in _RANGES], np.uint8)


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first bytes of the characters, and their code points."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead].astype(np.int64)
    size = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
    point = np.where(size == 1, first, first & (0xFF >> (size + 1)))
    padded = np.concatenate([data, np.full(3, 0x80, np.uint8)])
    for i in range(1, 4):
        more = size > i
        point[more] = point[more] << 6 | (padded[lead[more] + i] & 0x3F)
    return lead, point


def _scripts(data: np.ndarray) -> np.ndarray:
    """Script of every byte that begins a character, 0 for others."""
    out = np.zeros(len(data), np.uint8)
    if len(data) and data.max() >= 0x80:
        lead, point = _code_points(data)
        out[lead] = _SCRIPT[np.searchsorted(_FROM, point, side="right") - 1]
    else:
        out[((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))] = 1
    return out


class Words:
    """The words of some texts: bounds, bucket of every byte's trigram, letters and script."""

    def __init__(self, texts: pa.Array):
        low = pc.utf8_lower(texts.cast(pa.large_string()))
        data, at = utf8(low)
        self.begin, self.end, self.first = spans(data, at, WORD)
        # The byte before a word and the one after it count as a blank.
        blank = np.where(WORD[data], data, 32).astype(np.uint32)
        left = np.concatenate([[32], blank[:-1]]).astype(np.uint32)
        right = np.concatenate([blank[1:], [32]]).astype(np.uint32)
        if len(data):
            left[at[:-1][at[:-1] < len(data)]] = 32
            right[at[1:][at[1:] > 0] - 1] = 32
        key = left << np.uint32(16) | blank << np.uint32(8) | right
        self.bucket = ((key * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
        script = _scripts(data)
        self.letters = self._sums((script > 0).astype(np.int32))
        # A word's script is that of its first letter.
        place = np.flatnonzero(script)
        hit = np.searchsorted(place, self.begin)
        found = hit < len(place)
        self.script = np.zeros(len(self.begin), np.int64)
        inside = np.flatnonzero(found)
        inside = inside[place[hit[inside]] < self.end[inside]]
        self.script[inside] = script[place[hit[inside]]]
        self.byte = WORD[data] if len(data) else np.zeros(0, bool)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        if not len(self.begin):
            return np.zeros((0, *values.shape[1:]), values.dtype)
        return np.add.reduceat(values, np.column_stack([self.begin, self.end]).ravel()[:-1] if self.end[-1] >= len(values)
                               else np.column_stack([self.begin, self.end]).ravel())[::2]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: Natural logarithm of a bucket's share, of buckets without and with counts, language by language.
    floor: tuple[float, ...]
    seen: tuple[tuple[bytes, bytes], ...]  # uint16 buckets, float32 logarithms
    #: Per script, which languages are written in it.
    written: tuple[tuple[bool, ...], ...]

    def scores(self, begin: int, end: int) -> np.ndarray:
        """Table of some languages, bucket by bucket."""
        out = np.empty((BUCKETS, end - begin), np.float32)
        out[:] = np.array(self.floor[begin:end], np.float32)
        for j, (slots, values) in enumerate(self.seen[begin:end]):
            out[np.frombuffer(slots, np.uint16), j] = np.frombuffer(values, np.float32)
        return out


class Emissions:
    """Scores of words under all languages of a model."""

    def __init__(self, model: Model):
        self.model, self.size = model, len(model.languages)
        self.written = np.array(model.written)
        self.whole = model.scores(0, self.size) if self.size <= _HELD else None

    def _tables(self) -> Iterator[tuple[int, int, np.ndarray]]:
        if self.whole is not None:
            yield 0, self.size, self.whole
            return
        for a in range(0, self.size, _SOME):
            b = min(a + _SOME, self.size)
            yield a, b, self.model.scores(a, b)

    def __call__(self, w: Words, begin: int, end: int) -> np.ndarray:
        total = np.zeros((end - begin, self.size), np.float64)
        for a, b, table in self._tables():
            step, i = max(1 << 12, _GATHERED // (b - a)), begin
            while i < end:
                j = min(end, max(i + 1, int(np.searchsorted(w.end, w.begin[i] + step, side="right"))))
                low, high = w.begin[i], w.end[j - 1]
                # Even parts are words, odd parts what lies between two of them.
                bounds = np.column_stack([w.begin[i:j], w.end[i:j]]).ravel()[:-1] - low
                total[i - begin:j - begin, a:b] = np.add.reduceat(table[w.bucket[low:high]], bounds, axis=0)[::2]
                i = j
        # Languages not written in the word's script are out; a script of no language leaves the word to its neighbours.
        script = w.script[begin:end]
        allowed = self.written[script]
        some = allowed.any(1) & (script > 0)
        return np.where(some[:, None], np.where(allowed, total, total.min(1, keepdims=True) - 50.0), 0.0)


_COUNTS = StructType([StructField("lang", StringType()), StructField("slot", IntegerType()), StructField("n", LongType())])
_FLUSH = 64
#: Scores gathered at once.
_GATHERED = 1 << 22


def counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, slot, n) over the rows: trigram buckets, then letters by script. A task holds the tables of a few languages
    and hands the rest on, so its memory is bounded."""
    source = df.where(col(lang).isNotNull()).select(col(lang).cast("string").alias("l"), col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def packed(name: str) -> pa.RecordBatch:
            n = held.pop(name)
            slot = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([pa.array([name] * len(slot), pa.string()), pa.array(slot.astype(np.int32)),
                                               pa.array(n[slot])], names=["lang", "slot", "n"])

        for batch in batches:
            for piece in pieces(batch, "t", _PIECE):
                names = piece.column(0).to_pylist()
                for name in sorted(set(names)):
                    rows = pa.array([i for i, x in enumerate(names) if x == name])
                    w = Words(piece.column(1).take(rows))
                    n = held.setdefault(name, np.zeros(BUCKETS + SCRIPTS, np.int64))
                    n[:BUCKETS] += np.bincount(w.bucket[w.byte], minlength=BUCKETS)
                    n[BUCKETS:] += np.bincount(w.script, weights=w.letters, minlength=SCRIPTS).astype(np.int64)
                    if len(held) > _FLUSH:
                        yield packed(next(iter(held)))
        for name in list(held):
            yield packed(name)

    return source.mapInArrow(run, _COUNTS).groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, where: Column | None = None, text: str = "text", lang: str = "lang") -> Model:
    """A model from all rows for which ``where`` holds and whose language is not null. The driver gets the counts of some
    languages at a time and keeps six bytes of each bucket a language was seen in."""
    rows = df if where is None else df.where(where)
    all_counts = materialize(counts(rows, text, lang), "trigrams")
    names = sorted(r[0] for r in all_counts.select("lang").distinct().collect())
    floor: list[float] = []
    seen: list[tuple[bytes, bytes]] = []
    letters = np.zeros((SCRIPTS, len(names)))
    for a in range(0, len(names), _SOME):
        some = names[a:a + _SOME]
        got = all_counts.where(F.col("lang").isin(some)).toPandas()
        n = np.zeros((BUCKETS + SCRIPTS, len(some)))
        np.add.at(n, (got["slot"].to_numpy(), got["lang"].map({x: i for i, x in enumerate(some)}).to_numpy()), got["n"].to_numpy())
        every = n[:BUCKETS].sum(0) + 0.5 * BUCKETS
        floor += np.log(0.5 / every).tolist()
        for j in range(len(some)):
            slots = np.flatnonzero(n[:BUCKETS, j])
            seen.append((slots.astype(np.uint16).tobytes(), np.log((n[slots, j] + 0.5) / every[j]).astype(np.float32).tobytes()))
        letters[:, a:a + len(some)] = n[BUCKETS:]
    written = (letters > 0) & (letters >= SCRIPT_SHARE * letters.sum(0))
    return Model(tuple(names), tuple(floor), tuple(seen), tuple(tuple(map(bool, r)) for r in written) if names else ())


def _paths(emit: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best language of every word, for all texts at once: step t handles the t-th word of each text that has one."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    back = np.zeros(len(emit), np.int32)  # best language before the word, if it switched; -1 if it stayed
    stay = np.zeros(emit.shape, bool)
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    best = emit[begin[:active[0]]] if longest else np.zeros((0, emit.shape[1]))
    ends = np.zeros(len(size), np.int64)
    for t in range(longest):
        n = int(active[t])
        if t:
            now = begin[:n] + t
            best = best[:n] if n < len(best) else best
            top = best.argmax(1)
            jump = best[np.arange(n), top] - switch
            stay[now] = kept = best >= jump[:, None]
            back[now] = top
            best = np.where(kept, best, jump[:, None]) + emit[now]
        left = int(active[t + 1]) if t + 1 < longest else 0
        if left < n:
            ends[left:n] = best[left:].argmax(1)
    out = np.zeros(len(emit), np.int64)
    state = np.zeros(0, np.int64)
    for t in range(longest - 1, -1, -1):
        n = int(active[t])
        state = np.concatenate([state, ends[len(state):n]])
        now = begin[:n] + t
        out[now] = state
        if t:
            state = np.where(stay[now, state], state, back[now])
    return out


def _paths_by_blocks(w: Words, emissions: Emissions, switch: float, step: int) -> np.ndarray:
    """As ``_paths``, word by word, with the scores of ``step`` words at a time."""
    n = len(w.begin)
    fresh = np.zeros(n + 1, bool)
    fresh[w.first] = True
    back = np.zeros(n, np.int32)
    stay = np.zeros((n, (emissions.size + 7) // 8), np.uint8)
    out = np.zeros(n, np.int64)
    best = np.zeros(emissions.size)
    for i in range(0, n, step):
        emit = emissions(w, i, min(n, i + step))
        for t in range(i, i + len(emit)):
            if fresh[t]:
                best = emit[t - i]
            else:
                back[t] = best.argmax()
                jump = best[back[t]] - switch
                kept = best >= jump
                stay[t] = np.packbits(kept)
                best = np.where(kept, best, jump) + emit[t - i]
            if fresh[t + 1] or t + 1 == n:
                out[t] = best.argmax()
    for t in range(n - 1, 0, -1):
        if not fresh[t]:
            state = out[t]
            out[t - 1] = state if stay[t, state >> 3] >> (7 - (state & 7)) & 1 else back[t]
    return out


def label(texts: pa.Array, emissions: Emissions, switch: float = SWITCH) -> tuple[Words, np.ndarray, Iterator[tuple[int, int, np.ndarray]]]:
    """The words, the language number of each, and the scores in blocks of words: begin, end and scores."""
    w = Words(texts)
    n = len(w.begin)
    step = max(1, _CELLS // emissions.size)
    if n <= step:
        total = emissions(w, 0, n)
        return w, _paths(total, w.first, switch), iter([(0, n, total)])
    blocks = ((i, min(n, i + step), emissions(w, i, min(n, i + step))) for i in range(0, n, step))
    return w, _paths_by_blocks(w, emissions, switch, step), blocks


def identify(df: DataFrame, model: Model, keep=None, text: str = "text", switch: float = SWITCH, with_spans: bool = True) -> DataFrame:
    """``keep`` (all columns unless given), lang_pred, score and, ``with_spans``, ``lang_spans``: begin and end word and language.

    The score is the share of the letters in words of the language, times how sure those words are: 1 - 1 / (1 + margin),
    the margin being the mean difference to the next language, in nats per word.
    """
    span = StructType([StructField("begin", IntegerType()), StructField("end", IntegerType()), StructField("lang", StringType())])
    fields = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         *([StructField("lang_spans", ArrayType(span))] if with_spans else [])])
    arrow_span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def work():
        names = model.languages
        emissions = Emissions(model) if names else None
        most = max(1, _CELLS // max(1, len(names)))

        def run(texts: pa.Array) -> list[pa.Array]:
            n = len(texts)
            if n > most:
                return [pa.concat_arrays(x) for x in zip(*[run(texts.slice(i, most)) for i in range(0, n, most)])]
            if not names:
                return [pa.array(["und"] * n), pa.array([0.0] * n), *([pa.array([[]] * n, arrow_span)] if with_spans else [])]
            w, path, blocks = label(texts, emissions, switch)
            k = len(names)
            text_of = np.repeat(np.arange(n), np.diff(w.first))
            # Without a word the sums are whole numbers to numpy.
            letters = np.bincount(text_of * k + path, weights=w.letters, minlength=n * k).reshape(n, k).astype(float)
            top = letters.argmax(1)
            every = letters.sum(1)
            mine = path == top[text_of]
            sums = np.zeros((n, k))
            for a, b, total in blocks:
                sums += np.stack([np.bincount(text_of[a:b], weights=total[:, j] * mine[a:b], minlength=n) for j in range(k)], 1)
            words = np.maximum(np.bincount(text_of, weights=mine & (w.script > 0), minlength=n), 1)
            own = sums[np.arange(n), top]
            rest = sums.copy()
            rest[np.arange(n), top] = -np.inf
            margin = np.maximum((own - rest.max(1)) / words, 0) if k > 1 else np.full(n, np.inf)
            share = letters[np.arange(n), top] / np.maximum(every, 1)
            score = np.where(every > 0, share * (1 - 1 / (1 + margin)), 0.0)
            # Letters outside the ranges are looked for one by one, only where no other letter was seen.
            lone = [i for i in np.flatnonzero(every == 0).tolist() if any(map(str.isalpha, texts[i].as_py() or ""))]
            named = [names[j] if e > 0 else "und" for j, e in zip(top.tolist(), every.tolist())]
            for i in lone:
                named[i] = names[0]
            if not with_spans:
                return [pa.array(named, pa.string()), pa.array(score)]
            cut = np.ones(len(path), bool)
            cut[1:] = (path[1:] != path[:-1]) | (text_of[1:] != text_of[:-1])
            at = np.flatnonzero(cut)
            until = np.append(at[1:], len(path))
            base = w.first[:-1][text_of[at]] if len(at) else at
            rows: list[list[dict]] = [[] for _ in range(n)]
            for i, b, e, j in zip(text_of[at].tolist(), (at - base).tolist(), (until - base).tolist(), path[at].tolist()):
                if every[i] > 0:
                    rows[i].append({"begin": b, "end": e, "lang": names[j]})
            return [pa.array(named), pa.array(score), pa.array(rows, arrow_span)]
        return run

    return annotate(df, work, fields, keep, text, max(1 << 16, _PIECE * 4 // max(4, len(model.languages))))


def accept(df: DataFrame, model: Model, least: float = 0.1, **settings) -> DataFrame:
    """The rows whose language is known with at least this score, with the columns they had. Without a language to know,
    nothing is rejected."""
    if not model.languages:
        return df
    found = identify(df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(df.columns)]), model,
                     text=f"k{df.columns.index(settings.pop('text', 'text'))}", with_spans=False, **settings)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(df.columns)])
