"""Quality rules: statistics of a text, and a decision list learned from labelled statistics.

Sequential covering: a rule is grown condition by condition on two thirds of the labelled rows (information gain),
shortened on the other third, and kept if it is precise; the rows it covers are taken away and the next rule is grown.
The list becomes one Spark conditional expression. Rules say what to reject; a text no rule covers is kept.

Null text counts as empty: no words, so the base check fails. Empty tables give empty results; without labels of both
kinds the list is empty and only the base check rejects. Repeated rows each get their own result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import count
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gustline.llm.arrow import annotate, strings

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_marks", "n_distinct")
_WINDOW = 5


def _repeated(words: list[bytes]) -> tuple[int, int]:
    """Words inside windows found twice or more, and distinct words. Windows are compared exactly, by word numbers."""
    numbers: defaultdict = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    kinds, n = len(numbers), len(words) - _WINDOW + 1
    if n < 2 or kinds == len(words):
        return 0, kinds
    pair = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)[1]
    four = np.unique(pair[:-2] * (int(pair.max()) + 1) + pair[2:], return_inverse=True)[1]
    place, times = np.unique(four[:-1] * kinds + ids[4:], return_inverse=True, return_counts=True)[1:]
    change = np.zeros(len(words) + 1, np.int64)
    hit = np.flatnonzero(times[place] > 1)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + _WINDOW, -1)
    return int((np.cumsum(change) > 0).sum()), kinds


def describe(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = text.encode().split()
    seen: set[str] = set()
    lines = repeats = 0
    for line in text.split("\n"):
        if line.strip(" \t\r\v\f"):
            lines += 1
            if line in seen:
                repeats += 1
            else:
                seen.add(line)
    space = sum(text.count(c) for c in " \t\n\r\v\f")
    data = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(data, minlength=256)
    repeated, distinct = _repeated(words)
    # Upper case of two-byte letters does not matter here: the ratio is one of several features.
    return (len(words), len(text) - space, int(kinds[[35, 42, 36, 37, 38, 124, 60, 62]].sum()), repeats, repeated, lines,
            int(kinds[65:91].sum()), int(kinds[48:58].sum()), int(kinds[[33, 34, 40, 41, 44, 46, 58, 59, 63]].sum()), distinct)


def statistics(df: DataFrame, keep=("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and the counts of every row."""
    fields = StructType([StructField(c, LongType()) for c in COUNTS])

    def work():
        def run(texts: pa.Array) -> list[pa.Array]:
            rows = np.array([describe(t) for t in strings(texts)], np.int64).reshape(-1, len(COUNTS))
            return [pa.array(rows[:, i]) for i in range(len(COUNTS))]
        return run

    return annotate(df, work, fields, keep, text)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def _per(top: str, bottom: str) -> Column:
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1)).cast("double")


def features() -> dict[str, Column]:
    """What thresholds are learned on, from the counts."""
    return {
        "words": F.col("n_words").cast("double"), "chars_per_word": _per("word_chars", "n_words"),
        "symbols_per_word": _per("n_symbols", "n_words"), "repeated_lines": _per("n_dup_lines", "n_lines"),
        "repeated_words": _per("n_repeat_words", "n_words"), "words_per_line": _per("n_words", "n_lines"),
        "upper": _per("n_upper", "word_chars"), "digits": _per("n_digits", "word_chars"),
        "marks_per_word": _per("n_marks", "n_words"), "distinct": _per("n_distinct", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.feature] > self.limit if self.above else values[self.feature] <= self.limit

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > self.limit if self.above else of[self.feature] <= self.limit


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))), -np.inf)


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, cuts: int, most: int) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most:
        p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
        if not p0 or not n0:
            break
        best: tuple[float, Condition | None] = (1e-9, None)
        for name in sorted(values):
            x, y = values[name][inside], bad[inside]
            # Cuts between the quantiles of either class, so that a rare class has cuts of its own.
            at = np.unique(np.concatenate([np.quantile(part, np.linspace(0, 1, cuts)) for part in (x[y], x[~y])]))
            at = (at[:-1] + at[1:]) / 2
            if not len(at):
                continue
            up, un = np.sort(x[y]), np.sort(x[~y])
            pl, nl = np.searchsorted(up, at, "right"), np.searchsorted(un, at, "right")
            for above, p, n in ((True, len(up) - pl, len(un) - nl), (False, pl, nl)):
                gains = _gain(p, n, p0, n0)
                k = int(np.argmax(gains))
                if gains[k] > best[0]:
                    best = (float(gains[k]), Condition(name, above, float(at[k])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(values)
    return tuple(rule)


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        c = _covers(r, values, len(bad))
        p, n = int(bad[c].sum()), int((~bad[c]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    if not len(bad):
        return rule
    # The shortest of the best beginnings of the rule.
    return rule[:max(range(1, len(rule) + 1), key=lambda k: (worth(rule[:k]), -k))] if rule else rule


def learn(values: dict[str, np.ndarray], bad: np.ndarray, turn: np.ndarray, precision: float = 0.9, support: int = 5,
          most_rules: int = 16, most_conditions: int = 4, cuts: int = 65) -> list[Rule]:
    """Rules for the rows marked ``bad``. ``turn`` 0 or 1 grows, 2 prunes. Stops at the first rule that is not precise."""
    values = {k: np.asarray(v, float) for k, v in values.items()}
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < most_rules and bad[left].any():
        grow, prune = left & (turn != 2), left & (turn == 2)
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow], cuts, most_conditions)
        rule = _prune(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        hit = _covers(rule, values, len(bad)) & left
        p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
        held = prune & hit
        if not rule or p < support or p < precision * (p + n) or bad[held].sum() < precision * held.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", rows: int = 60_000, **settings) -> list[Rule]:
    """A list from at most ``rows`` labelled rows, those with the smallest hashed keys. Label 0 is what to reject;
    of contradicting labels of a key the smaller counts."""
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("y"))
    named = features()
    sample = (
        stats.join(marks, key).select(F.xxhash64(key).alias("h"), "y", *[c.alias(n) for n, c in named.items()])
        .orderBy("h", *named).limit(rows).toPandas()
    )
    if not len(sample):
        return []
    turn = sample["h"].to_numpy().astype(np.uint64) % np.uint64(3)
    return learn({n: sample[n].to_numpy() for n in named}, sample["y"].to_numpy() == 0, turn, **settings)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that covers the row, from 1; 0 if none does."""
    of = features()
    out = None
    for i, rule in enumerate(rules, 1):
        test = rule[0].column(of)
        for c in rule[1:]:
            test = test & c.column(of)
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def apply(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``base_failed``, ``rule`` and ``kept`` beside the counts."""
    return stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0))
