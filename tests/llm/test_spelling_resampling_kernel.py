"""Operators 11 to 13 against brute force, and their defined results on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gustline.llm import kernel, resampling, spelling

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{'abcdefgh'[i % 8]}{'klmnop'[i % 6]}" for i in range(60_000))
ODD = [None, "", " \t\n ", "a", LONG, "same words here again", "same words here again", "é ß 漢字  x", "\0 nul", "x" * 100_000]


def docs(spark, texts, keys=None):
    keys = range(len(texts)) if keys is None else keys
    return spark.createDataFrame([(k, t, "en", "s", None) for k, t in zip(keys, texts)], DOCS)


# 11, spelling variants

def near_slowly(a, b):
    """One insertion, deletion or replacement, by dynamic programming."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1] == 1


def words_slowly(rows):
    n = Counter()
    for key, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def variants_slowly(n):
    out, form = {}, {}
    for w in n:
        near = [v for v in n if near_slowly(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = (n[w], len(near), form[w], n.get(form[w]))
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] += (root,)
    return out


def random_words(rng, count, letters="abé", low=5, high=9):
    return ["".join(rng.choice(list(letters), rng.integers(low, high + 1))) for _ in range(count)]


@pytest.mark.parametrize("c", [5, 6, 9])
def test_block_finds_all_pairs(c):
    rng = np.random.default_rng(c)
    words = sorted(set(random_words(rng, 300, low=c, high=c + 1)))
    a, b = spelling.near_in_block([w.encode("latin-1") for w in words], c)
    got = {(words[i], words[j]) for i, j in zip(a.tolist(), b.tolist())}
    assert len(got) == len(a)
    assert got == {(x, y) for x in words if len(x) == c for y in words if near_slowly(x, y)}


@pytest.mark.parametrize("block", [2048, 16, 3])
def test_variants_equal_brute_force(spark, block):
    """Also with blocks so small that groups are filed again, down to the last letter."""
    rng = np.random.default_rng(7)
    pool = random_words(rng, 250)
    texts = [" ".join(rng.choice(pool, 60, p=np.arange(250, 0, -1) / np.arange(251).sum())) for _ in range(60)] + [
        "ABCDE abcde Abcde abcdf abcdf abcdf aÀcde aÀcde aÀcde aàcde×aàcde÷aàcde1abcde", None, ""]
    keys = [*range(len(texts) - 1), None]
    got = spelling.variants(docs(spark, texts, keys), block=block).collect()
    want = variants_slowly(words_slowly(zip(keys, texts)))
    assert len(got) == len(want) > 200
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == want


def test_variants_on_odd_rows(spark):
    frame = docs(spark, ODD + ["y" * 30_000 + " z"] * 3).withColumn("word", F.lit("clash")).withColumn("n", F.lit("clash"))
    got = {r["word"]: r for r in spelling.variants(frame).collect()}
    assert got["wordak"]["n"] > 0 and got["again"]["n"] == 2 if "again" in got else True
    assert {w: r["n"] for w, r in got.items()} == words_slowly(enumerate(ODD + ["y" * 30_000 + " z"] * 3))
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [None, ""])).count() == 0


def test_long_chain_of_forms(spark):
    """A word whose form has a form, and so on, to more steps than one turn takes."""
    chain = ["abcdefgh"[:5] + "x" * i for i in range(9)]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2 ** i))
    key = next(k for k in range(1000) if all(zlib.crc32(f"{k}:{w}".encode()) % 97 for w in chain))
    got = {r["word"]: r["root"] for r in spelling.variants(docs(spark, [text], [key])).collect()}
    assert got == {w: chain[-1] for w in chain}


# 12, importance resampling

def features_slowly(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return w, [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def bucket(x):
    return zlib.crc32(x.encode()) % 10_000


def resampled_slowly(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, features_slowly(text)[1]))
    for text in target:
        t.update(map(bucket, features_slowly(text)[1]))
    every, other = sum(s.values()), sum(t.values())
    out = []
    for i, (key, text) in enumerate(rows):
        words, found = features_slowly(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (every + 10_000) / ((s[b] + 1) * (other + 10_000)))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words), i])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0], r[6]))
    for k, r in enumerate(able[:5 * len(able) // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("size", [1, 255, 256, 257, 70_000, 300_000])
def test_running_crc_and_shifts(size):
    rng = np.random.default_rng(size)
    stream = rng.integers(0, 256, size, np.uint8)
    running = resampling.Running(stream)
    a, b = np.sort(rng.integers(0, size + 1, (2, 200)), axis=0)
    found = running.at(b) ^ resampling.shifted(running.at(a) ^ np.uint32(0xFFFFFFFF), b - a) ^ np.uint32(0xFFFFFFFF)
    raw = stream.tobytes()
    assert found.tolist() == [zlib.crc32(raw[i:j]) for i, j in zip(a.tolist(), b.tolist())]


def test_buckets_equal_brute_force():
    texts = [*ODD, "One-TWO three;four", "z" * 1000 + " q " + "y" * 70_000 + " end", "Ünïcode 漢字 и ещё"]
    words, found, first = resampling.buckets(pa.array(texts))
    for k in (1, 2, 3):
        want = [bucket(x) for t in texts for w in [features_slowly(t)[0]] for x in (" ".join(w[i:i + k]) for i in range(len(w) - k + 1))]
        assert found[k - 1].tolist() == want
    assert np.diff(first).tolist() == [len(features_slowly(t)[0]) for t in texts]


def test_resample_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    pool = random_words(rng, 60, "abc", 1, 6)
    texts = [" ".join(rng.choice(pool, rng.integers(0, 60))) for _ in range(300)] + [None, "", "x" * 5000] + [" ".join(pool)] * 3
    # Equal keys draw equal noise, so copies of a text with one key tie.
    rows = [*enumerate(texts), *[(5, texts[5])] * 4, (None, texts[7]), (None, texts[7])]
    target = [" ".join(rng.choice(pool[:20], 40)) for _ in range(20)] + [None]
    frame = docs(spark, [t for _, t in rows], [k for k, _ in rows]).withColumn("bucket", F.lit("clash")).withColumn("score", F.lit("clash"))
    items = spark.createDataFrame([(t,) for t in target], "text string")
    got = [tuple(r) for r in resampling.resample(frame, items).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    order = lambda r: [(x is None, x or 0) for x in r]
    want = resampled_slowly(rows, target)
    assert sum(r[4] is not None for r in want) >= 10
    assert sorted(got, key=order) == sorted(want, key=order)


def test_resample_on_odd_rows(spark):
    target = spark.createDataFrame([], "text string")
    got = {r["doc_id"]: r for r in resampling.resample(docs(spark, ODD), target).collect()}
    assert len(got) == len(ODD) and got[0]["weight"] == 0 and got[4]["n_words"] == 60_000
    assert all(r["rank"] is None for r in got.values())
    assert resampling.resample(docs(spark, []), target).count() == 0
    one = resampling.resample(docs(spark, [LONG] * 20), target).where("rank is not null").collect()
    assert [r["rank"] for r in one] == [1]


# 13, quality classifier

def test_statistics_by_hand():
    x = dict(zip(kernel.STATISTICS, kernel.describe(pa.array(["Aa bb## CC\nAa bb## CC\n  \nlast 12 !!"]))[0]))
    assert x["words"] == pytest.approx(math.log1p(9)) and x["word_size"] == pytest.approx((2 + 4 + 2 + 2 + 4 + 2 + 4 + 2 + 2) / 9)
    assert x["repeated_lines"] == pytest.approx(1 / 3) and x["distinct"] == pytest.approx(6 / 9) and x["top_word"] == pytest.approx(2 / 9)
    assert x["symbol_words"] == pytest.approx(2 / 9) and x["upper_words"] == pytest.approx(2 / 9) and x["bare_words"] == pytest.approx(2 / 9)
    assert x["repeated_pairs"] == pytest.approx(2 / 8) and x["repeated_fives"] == 0
    assert not np.isnan(kernel.describe(pa.array(ODD))).any() and (kernel.describe(pa.array([None, "", "  "]))[:, 0] == 0).all()


def test_statistics_do_not_depend_on_neighbours():
    alone = np.vstack([kernel.describe(pa.array([t], pa.string())) for t in ODD])
    assert np.allclose(alone, kernel.describe(pa.array(ODD)))


def test_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, len(kernel.STATISTICS)))
    width = 4.0
    m = kernel.Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), rng.normal(0, 1 / width, (x.shape[1], 20_000)),
                     rng.uniform(0, 2 * np.pi, 20_000), np.zeros(0), (np.zeros(0),) * 2, 100.0, 0.5)
    z = kernel.features(x, m)[:, :-1] / kernel._UNIT
    got = 2 * z @ z.T / 20_000
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * width ** 2))
    assert np.abs(got - want).max() < 0.05


def test_equations_equal_sums_over_all_rows(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(500, len(kernel.STATISTICS))), rng.integers(0, 2, 500)
    m = kernel.Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), rng.normal(0, 0.25, (x.shape[1], 20)), rng.uniform(0, 6, 20),
                     np.zeros(0), (np.zeros(0),) * 2, 5.0, 0.5)
    rows = spark.createDataFrame([(int(v), *map(float, r)) for v, r in zip(y, x)], ["y", *kernel.STATISTICS])
    a, b = kernel._equations(rows.repartition(7), m)
    z = kernel.features(x, m) / kernel._UNIT
    assert np.allclose(a, z.T @ z) and np.allclose(b, z.T @ y)


def test_pooling_is_isotonic_and_best():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = rng.integers(1, 5, 8)
        y = rng.integers(0, n + 1)
        p = kernel.pooled(y.astype(float), n.astype(float))
        assert (np.diff(p) >= -1e-12).all()
        # The largest of the smallest averages: the definition of the isotonic fit.
        want = [max(min(y[i:j].sum() / n[i:j].sum() for j in range(k + 1, 9)) for i in range(k + 1)) for k in range(8)]
        assert np.allclose(p, want)


def test_quality_on_held_out_rows(spark):
    rng = np.random.default_rng(5)
    words = random_words(rng, 400, "abcdefgh", 2, 10)
    texts, marks = [], []
    for i in range(800):
        w = list(rng.choice(words, rng.integers(10, 80)))
        bad = i % 3 == 0
        texts.append(" | ".join(w) if bad and i % 2 else " ".join(w).upper() if bad else " ".join(w) + ".")
        marks.append(0 if bad else 1)
    stats = kernel.statistics(docs(spark, texts))
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id bigint, quality int")
    held = F.col("doc_id") % 4 == 2
    got = {r["doc_id"]: r["score"] for r in kernel.score(stats, kernel.fit(stats, labels, ~held)).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    right = [(got[i] >= 0.7) == (marks[i] == 1) for i in range(800) if i % 4 == 2]
    assert np.mean(right) > 0.97


def test_quality_on_odd_rows(spark):
    frame = docs(spark, ODD).withColumn("words", F.lit("clash")).withColumn("y", F.lit("clash"))
    stats = kernel.statistics(frame)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in kernel.score(stats, kernel.fit(stats, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id bigint, quality int")
    assert {r["score"] for r in kernel.score(stats, kernel.fit(stats, ones)).collect()} == {1.0}
    few = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(1, 0)], "doc_id bigint, quality int")
    got = kernel.score(stats, kernel.fit(stats, few)).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    empty = kernel.statistics(docs(spark, []))
    assert kernel.score(empty, kernel.fit(empty, few)).count() == 0
