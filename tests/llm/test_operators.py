"""The operators against brute force, and their defined results for nulls, empty and long texts, ties, repeated rows, empty
tables and clashing column names."""

import hashlib
import math
import re
from collections import Counter
from datetime import date

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gustline.llm import decontaminate, html, language, lm, mixing, nearcopies, pseudonyms, rules, simhash, toxicity, warc
from gustline.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def docs(spark, texts, **columns):
    rows = [(i, t, "en", f"s{i % 3}", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " \t\n ", "a", LONG, "same words here again", "same words here again", "é ß 漢字  x", "\0 nul", "x" * 100_000]


# 1, quality rules

def slow_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


@pytest.mark.parametrize("text", ["", "a b c d e f a b c d e", "x\nx\n\n \nx y\n x", "# a|b <c> é é é é é é é", "a " * 50, LONG, "  a"])
def test_statistics_equal_brute_force(text):
    assert rules.describe(text)[:5] == slow_statistics(text)


def test_rules_find_a_threshold_conjunction():
    rng = np.random.default_rng(1)
    x, y = rng.random(3000), rng.random(3000)
    found = rules.learn({"x": x, "y": y}, (x > 0.7) & (y <= 0.4), np.arange(3000) % 3)
    hit = np.zeros(3000, bool)
    for r in found:
        hit |= rules._covers(r, {"x": x, "y": y}, 3000)
    assert (hit == ((x > 0.7) & (y <= 0.4))).mean() > 0.98
    assert rules.learn({"x": x}, np.zeros(3000, bool), np.arange(3000) % 3) == []


def test_rules_on_odd_rows(spark):
    stats = rules.statistics(docs(spark, ODD).withColumn("n_words", F.lit("clash")))
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    assert rules.fit(stats, empty) == []
    got = {r["doc_id"]: r for r in rules.apply(stats, []).collect()}
    assert len(got) == len(ODD) and got[0]["n_words"] == 0 and got[0]["base_failed"] and not got[0]["kept"]
    assert got[4]["n_words"] == 60_000 and got[4]["base_failed"]
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    rules.fit(stats, labels)
    assert rules.apply(rules.statistics(docs(spark, [])), []).count() == 0


# 2, toxicity

def test_toxicity_held_out(spark):
    rng = np.random.default_rng(2)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    def word():
        return "".join(rng.choice(syllables, rng.integers(2, 5)))
    texts, marks = [], []
    for i in range(600):
        w = [word() for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                w[rng.integers(60)] = str(rng.choice(["wretchling", "grubface", "numbskull"]))
        texts.append(" ".join(w))
        marks.append((i, int(toxic)))
    df, labels = docs(spark, texts), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    model = toxicity.fit(df, labels, F.col("doc_id") % 5 != 0)
    got = toxicity.score(df, model).toPandas().set_index("doc_id")["score"]
    held = [(got[i], y) for i, y in marks if i % 5 == 0]
    assert np.mean([(s >= 0.5) == bool(y) for s, y in held]) > 0.95
    odd = toxicity.score(docs(spark, ODD), model).toPandas()
    assert len(odd) == len(ODD) and odd["score"].between(0, 1).all()
    assert got[0] == toxicity.score(docs(spark, [texts[0], texts[0]]), model).toPandas()["score"].iloc[1]


def test_toxicity_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(docs(spark, ODD), empty)
    assert toxicity.score(docs(spark, ODD), model).agg(F.max("score")).first()[0] == 0.0
    assert toxicity.score(docs(spark, []), model).count() == 0


# 3, html

PAGE = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><div class='notice'>We use cookies</div>"
        "<div class='post-%d'><h1>Head &amp; line</h1><p>First <b>bo</b>ld\n text.<p>Second&nbsp;one<br>here<ul><li>a<li>b</ul>"
        "<form><p>Mail</p></form><div id='comments'><p>Nice!</p></div></div><aside>Side</aside><footer>&copy;</footer>"
        "<script>var x = '<p>no</p>'</script></body></html>")


def test_pages(spark):
    rows = [(i, f"https://u@Site.example:8{i}/x" if i % 4 else None, PAGE % i, "kept") for i in range(8)] + [(8, "x", None, ""), (9, "", "", ""), (10, "http://a/", "plain <b text", "")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text string")
    got = {r["page_id"]: r for r in html.articles(df).collect()}
    assert len(got) == 11 and got[1]["text"] == "Head & line First bold text. Second one here a b" and got[0]["text"] == got[1]["text"]
    assert got[1]["path"] == "html>body>div.post-#" and got[8]["text"] == "" and got[9]["text"] == ""
    assert html.articles(df.where("false")).count() == 0


def test_host_path_wins_over_own():
    text = "<body><main><p>Short.</p></main><div class='x'><p>A much longer list of things beside it.</p></div></body>"
    assert html.extract(text, ["body>main"])[0] == "Short." and html.extract(text, ["body>none"])[1] != "body>main"


ARTICLE = " ".join(f"Sentence {i} of the article says something." for i in range(20))


def test_host_path_of_another_template(spark):
    common = "<body><div class='text'><h1>T</h1><p>%s</p></div></body>"
    other = "<body><div class='long'><h1>T</h1><p>%s</p></div><div class='text'><p>A teaser of another article.</p></div></body>"
    rows = [(i, None, (other if i == 0 else common) % f"{ARTICLE} {i}") for i in range(9)]
    got = {r["page_id"]: r["text"] for r in html.articles(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert all(got[i].startswith(f"T {ARTICLE} {i}") for i in range(9))


@pytest.mark.parametrize("begin, end", [
    *[(f"<div class='{c}'>", "</div>") for c in ("content has-sidebar", "no-sidebar", "fixed-header", "comments-open")],
    ("<section id='header-fixed'>", "</section>"), ("<form action='x.aspx'>", "</form>"),
    ("<form><div class='no-sidebar'><div class='widgets-ready'>", "</div></div></form>")])
@pytest.mark.parametrize("heading", ["<h1>T</h1>", "<p>T</p>"])
def test_marks_of_boxes_around_the_page(begin, end, heading):
    side = "<div class='sidebar'><p>Beside it.</p></div><div id='comments'><p>Nice!</p></div><nav><p>Menu of it</p></nav>"
    text = f"<body>{begin}<div class='x'>{heading}<p>{ARTICLE}</p></div>{side}{end}</body>"
    assert html.extract(text, [])[0] == f"T {ARTICLE}"
    assert html.extract(f"<body><p>Site</p>{begin}<h1>T</h1><p>{ARTICLE}</p>{side}{end}</body>", [])[0].endswith(f"T {ARTICLE}")


def test_long_comments_stay_out():
    text = f"<body><div class='x'><h1>T</h1><p>{ARTICLE}</p></div><div id='comments'><p>{ARTICLE} {ARTICLE}</p></div></body>"
    assert html.extract(text, [])[0] == f"T {ARTICLE}"


@pytest.mark.parametrize("text", ["<", "<a", "<!--", "<p", "</", "<script>", "a<b", "<div " + "a" * 5000, "<p>" * 3000, "<div>" * 500 + "x", "&#0;&bad;&amp"])
def test_broken_markup(text):
    html.extract(text, ["p"])


# 4, WARC

def test_warc_round_trip(spark, tmp_path):
    big = "ü" * 600
    rows = [(1, "http://a", big), (5, None, big), (3, "http://c\nx", big), (2, "", None), (4, "d", "small"), (6, "d", "small"), (5, None, big), (None, "n", big)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = str(tmp_path / "w")
    warc.archive(df.repartition(3), path)
    warc.archive(df.where("false"), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0
    back = warc.read(spark, path).collect()
    assert len(back) == len(rows)
    kinds = Counter((r["record_id"], r["warc_type"], r["refers_to"]) for r in back)
    assert kinds["urn:page:5", "response", None] == 2 and kinds["urn:page:1", "revisit", "urn:page:5"] == 1
    assert kinds["urn:page:null", "revisit", "urn:page:5"] == 1 and kinds["urn:page:4", "response", None] == 1
    for r in back:
        body = next((h or "").encode() for i, _, h in rows if f"urn:page:{'null' if i is None else i}" == r["record_id"])
        assert r["payload_digest"] == hashlib.sha1(body).hexdigest() and r["payload_length"] == len(body)
        assert r["payload"] == (None if r["warc_type"] == "revisit" else body)


def test_warc_pushes_filters_and_skips_payloads(spark, tmp_path):
    path = str(tmp_path / "w")
    df = spark.range(20).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.col("id").cast("string"), 5000).alias("html"))
    warc.archive(df, path)
    for mode in ("true", "false"):
        spark.conf.set("spark.sql.python.filterPushdown.enabled", mode)
        got = warc.read(spark, path, "record_id string, warc_type string, content_length bigint").where(
            "record_id = 'urn:page:7' AND warc_type = 'response'")
        assert [r["record_id"] for r in got.collect()] == ["urn:page:7"]
        assert warc.read(spark, path).where("NOT record_id = 'urn:page:7'").count() == 19
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert warc.read(spark, path, **{"header.warc-record-id": "<urn:page:3>"}).count() == 1


@pytest.mark.parametrize("pack", [warc.member, lambda b: __import__("gzip").compress(b), lambda b: b])
def test_warc_reader_on_other_writers(pack):
    import io
    records = [warc.record(f"urn:page:{i}", "response", "u", warc.DATE, "00" * 20, b"x" * 300_000, 300_000, None) for i in range(3)]
    data = b"".join(pack(r) for r in records)
    assert [r["payload_length"] for r in warc._Reader(io.BytesIO(data), lambda h: True, True)] == [300_000] * 3
    reader = warc._Reader(io.BytesIO(data), lambda h: h["warc-record-id"] == "<urn:page:2>", False)
    assert [r["record_id"] for r in reader] == ["urn:page:2"]
    if pack is not records and data[:2] != b"\x1f\x8b" or pack is warc.member:
        assert reader.inflated < 20_000


# 5, language model

def test_lm_counts_equal_brute_force(spark):
    texts = [*ODD[:9], "The cat sat", "the CAT ran", "a b a b a b"] * 2
    df = docs(spark, texts)
    got = {r["doc_id"]: r for r in lm.score(df, F.col("doc_id") % 5 != 1).collect()}
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for t in texts]
    seen = Counter(w for i, t in enumerate(tokens) if i % 5 != 1 for w in t)
    n, v = sum(seen.values()), len(seen)
    for i, t in enumerate(tokens):
        base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(t), sum(seen[w] > 0 for w in t), n)
        assert got[i]["base_score"] == pytest.approx(base, rel=1e-9) and got[i]["score"] < 0
    assert lm.score(df.where("false"), F.lit(True)).count() == 0
    assert lm.score(df, F.lit(None).cast("boolean")).agg(F.max("n_known")).first()[0] == 0


def test_lm_probabilities_of_all_words_add_up():
    import pyarrow as pa
    h, c, size = lm.tokens(pa.array(["a b c a b", "c a"]))
    s = lm.Settings(rows=256)
    trainer = lm.Trainer(np.zeros((s.rows + s.classes + 1, s.classes), np.float32), s)
    context = lm.Context(h, c, size, s)
    trainer.learn(context)
    every = np.zeros(len(h))
    for kind in range(s.classes):
        other = lm.Context(h, c, size, s)
        other.c = np.full(len(c), kind, np.uint8)
        every += np.exp(lm.log_classes(trainer.w, other))
    assert every == pytest.approx(np.ones(len(h)), abs=1e-5)


# 6, language

def corpus(spark):
    en, de = "the cat and the dog with this house", "der hund und die katze mit dem haus"
    rows = [(i, " ".join(np.random.default_rng(i).permutation((en if i % 2 else de).split() * 4)), "en" if i % 2 else "de") for i in range(60)]
    rows += [(60, "кошка и собака " * 9, "ru"), (61, None, "en"), (62, "12 34", "de"), (63, "the cat", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_language(spark):
    df = corpus(spark)
    model = language.fit(df, F.col("doc_id") % 4 != 2)
    assert model.languages == ("de", "en", "ru")
    got = {r["doc_id"]: r for r in language.identify(df.withColumn("Score", F.lit(1)), model).collect()}
    assert all(got[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(60))
    assert got[60]["lang_pred"] == "ru" and got[61]["lang_pred"] == got[62]["lang_pred"] == "und" and got[62]["score"] == 0
    mixed = docs(spark, ["the cat and the dog with this house and the dog der hund und die katze mit dem haus und die katze", *ODD])
    spans = {r["doc_id"]: r for r in language.identify(mixed, model).collect()}
    assert [s["lang"] for s in spans[0]["lang_spans"]] == ["en", "de"] and spans[0]["lang_spans"][0]["end"] in (10, 11, 12)
    assert len(spans) == len(ODD) + 1 and spans[2]["lang_pred"] == "und"
    assert language.accept(mixed, model).columns == mixed.columns
    none = language.fit(df.where("false"))
    assert {r["lang_pred"] for r in language.identify(mixed, none).collect()} == {"und"} and language.accept(mixed, none).count() == len(ODD) + 1


def test_viterbi_equals_brute_force():
    from itertools import product
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 7):
        emit = rng.normal(size=(n, 3)) * 3
        best = max(product(range(3), repeat=n), key=lambda p: sum(emit[i, s] for i, s in enumerate(p)) - 2 * sum(a != b for a, b in zip(p, p[1:])))
        assert tuple(language._paths(emit, np.array([0, n]), 2.0)) == best
    emit = rng.normal(size=(9, 2))
    both = language._paths(emit, np.array([0, 0, 3, 9]), 1.0)
    assert list(both) == [*language._paths(emit[:3], np.array([0, 3]), 1.0), *language._paths(emit[3:], np.array([0, 6]), 1.0)]


def many_languages(n):
    """Texts of n languages with words of their own; the last one in a script that no other has."""
    rng = np.random.default_rng(11)
    words = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for _ in range(n - 1)]
    words.append(["".join(chr(0x10D0 + i) for i in rng.integers(0, 33, 6)) for _ in range(12)])
    return [(k * 2 + i, " ".join(rng.choice(w, 30)), f"l{k:04d}", "s", None) for k, w in enumerate(words) for i in range(2)]


def test_every_language_is_kept(spark):
    rows = many_languages(300)
    # The last language has the least text.
    rows[-1] = (*rows[-1][:1], " ".join(rows[-1][1].split()[:5]), *rows[-1][2:])
    rows[-2] = (*rows[-2][:1], rows[-1][1], *rows[-2][2:])
    df = spark.createDataFrame(rows, DOCS)
    model = language.fit(df)
    assert len(model.languages) == 300
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, model).collect()}
    assert got == {r[0]: r[2] for r in rows}
    assert language.accept(df, model).count() == len(rows)


def test_blocks_of_words_and_languages_change_nothing(monkeypatch, spark):
    import pyarrow as pa
    rows = many_languages(20)
    model = language.fit(spark.createDataFrame(rows, DOCS))
    texts = pa.array([rows[0][1] + " " + rows[9][1] + " " + rows[-1][1], *[x for x in ODD if x != LONG], *[r[1] for r in rows[::4]]])
    w, path, blocks = language.label(texts, language.Emissions(model))
    whole = next(blocks)[2]
    for cells in (20 * 7, 20 * 100):
        monkeypatch.setattr(language, "_CELLS", cells)
        monkeypatch.setattr(language, "_HELD", 4)
        monkeypatch.setattr(language, "_SOME", 3)
        _, parted, blocks = language.label(texts, language.Emissions(model))
        blocks = list(blocks)
        assert len(blocks) > 1 and max(len(x) for _, _, x in blocks) <= cells // 20
        assert (parted == path).all() and np.allclose(np.concatenate([x for _, _, x in blocks]), whole, atol=1e-3)


# 7, near-duplicates

def slow_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [*ODD, "A b", "a B c d"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == slow_print(text)


@pytest.mark.parametrize("chunk", [2, 50, 4096])
def test_links_and_components(spark, chunk):
    rng = np.random.default_rng(chunk)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    found = {int(b) for b in base} | {0, (1 << 64) - 1}
    for b in base.tolist():
        for _ in range(6):
            for k in rng.choice(64, rng.integers(1, 5), replace=False).tolist():
                b ^= 1 << k
            found.add(b)
    values = np.array(sorted(found), np.uint64)
    above = list(range(len(values)))
    def root(i):
        return i if above[i] == i else root(above[i])
    for i, j in zip(*np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)):
        a, b = root(int(i)), root(int(j))
        above[max(a, b)] = min(a, b)
    signed = values.view(np.int64).tolist()
    rows = [(i, fp) for i, fp in enumerate(signed)] + [(None, signed[0]), (1000, signed[3])]
    prints = spark.createDataFrame(rows, "doc_id bigint, fp bigint")
    got = {r["fp"]: r["component_id"] for r in simhash.cluster(prints, "doc_id", 2, chunk).collect()}
    assert got == {signed[i]: root(i) for i in range(len(values))}


def test_components_of_a_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (5, 4)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(path, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_one_of_each(spark):
    df = docs(spark, ODD).union(docs(spark, ODD)).withColumn("fp", F.lit("clash"))
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    texts = Counter(r["text"] for r in kept.collect())
    assert len(texts) == 7 and set(texts.values()) == {1}  # null, empty and blank are one, the repeated text is one
    assert simhash.near_duplicates(docs(spark, ODD)).count() == len(ODD)
    assert simhash.one_of_each(docs(spark, [])).count() == 0


# The pipeline's near copies

def near_copies(seed):
    """Texts, copies of them with words replaced at places drawn, and copies of copies; some end up below the limit."""
    rng = np.random.default_rng(seed)
    texts = []
    for n in (4, 6, 30, 100, 300, 800) * 6:
        words = [f"w{i}" for i in rng.integers(0, 5000, n)]
        texts.append(" ".join(words))
        for changes in (0, 1, *(max(1, round(n * x)) for x in (0.01, 0.02, 0.022, 0.025, 0.03, 0.05))):
            words = list(words) if rng.random() < 0.3 else texts[-1].split()
            for i in rng.choice(n, min(n, changes), replace=False):
                words[i] = f"W{rng.integers(0, 5000)}"
            texts.append(" ".join(words))
    return texts


def slow_kept(texts, least=0.8):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))})
    above = list(range(len(texts)))
    def root(i):
        return i if above[i] == i else root(above[i])
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= least * len(a | sets[j]):
                x, y = root(i), root(j)
                above[max(x, y)] = min(x, y)
    return {i for i in range(len(texts)) if root(i) == i}


def test_near_copies_equal_brute_force(spark):
    texts = near_copies(1)
    # A hub whose copies are no copies of each other, and a line that all of a group begin with.
    hub = [f"h{i}" for i in range(200)]
    texts += [" ".join(hub)] + [" ".join(w if i not in range(b, b + 18) else f"x{b}" for i, w in enumerate(hub)) for b in range(0, 180, 20)]
    texts += [" ".join(hub[:12] + [f"y{b}_{i}" for i in range(60)]) for b in range(30)]
    want = slow_kept(texts)
    assert len(texts) / 5 < len(want) < len(texts)
    got = corpus_pipeline.near_duplicates(spark, docs(spark, texts).repartition(5), "")
    assert {r["doc_id"] for r in got.collect()} == want


def test_near_copies_of_odd_rows(spark):
    df = docs(spark, ODD).union(docs(spark, ODD)).withColumn("row", F.lit("clash"))
    kept = nearcopies.one_of_each(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    assert Counter(r["text"] for r in kept.collect()) == Counter(ODD[i] for i in slow_kept(ODD))
    assert nearcopies.one_of_each(docs(spark, [])).count() == 0


def test_near_copies_meet_by_their_fingerprints(spark):
    """Texts that share no bucket are candidates if SimHash links them; one with a borrowed fingerprint fails the exact check."""
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in rng.integers(0, 5000, 800)]
    texts = [" ".join(words)] + [" ".join(words[:i] + ["new"] + words[i + 1:]) for i in range(0, 800, 20)] + ["quite another text of nine words with no copy"]
    prints = [simhash.fingerprint(t.encode(), nearcopies.SHINGLE) for t in texts]
    prints[-1] = prints[0]
    near = {i for i, p in enumerate(prints[:-1]) if i and (p ^ prints[0]).bit_count() <= simhash.RADIUS}
    assert near
    rows = [(i, t, [100 * i + b for b in range(nearcopies.BANDS)], bytearray(nearcopies.minima(nearcopies.shingles(t.encode())).astype(np.uint8).tobytes()),
             int(np.array(p, np.uint64).view(np.int64))) for i, (t, p) in enumerate(zip(texts, prints))]
    df = spark.createDataFrame(rows, "row bigint, t string, buckets array<bigint>, sketch binary, fp bigint")
    roots = {r["node"]: r["root"] for r in components(nearcopies.links(df)).collect()}
    assert {0, *near} <= {i for i, r in roots.items() if r == 0} and len(texts) - 1 not in roots


# 8, personal data

@pytest.mark.parametrize("n", [2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation_without_fixed_points(n):
    f = pseudonyms.Feistel(b"k", "x", n)
    image = [f.apply(i) for i in range(n)]
    assert sorted(image) == list(range(n)) and all(f.undo(y) == i != y for i, y in enumerate(image))


SAMPLES = [
    "4111 1111 1111 1111", "5500-0000-0000-0004", "a.b+c@mail-9.example.com", "+1 (555) 123-4567", "555-123-4567", "10.0.0.1", "2020-02-29",
    "31.12.1999", "12/31/1999", "3/4/2001", "DE89 3704 0044 0532 0130 00", "123-45-6789", "9ef9f999dec999d9b99fdf99", "AB9EF9F999DEC999D9B99FDF"]


def test_pseudonyms(spark):
    codec = pseudonyms.Codec(b"k")
    for value in SAMPLES:
        text = f"x {value}, y ({value})"
        new, found = pseudonyms.replace(text, codec)
        a, b = re.match(r"x (.*), y \((.*)\)$", new).groups()
        assert a == b != value and sum(found.values()) == 2, value
        assert re.sub("[0-9A-Za-z]", "", a) == re.sub("[0-9A-Za-z]", "", value)
        assert len(a) == len(value) or "." in value or "/" in value
        assert pseudonyms.replace(new, codec, False)[0] == text
    for plain in ("4111 1111 1111 1112", "300.1.1.1", "2021-02-30", "word 12 34", "1234567890123456", "a@b"):
        assert pseudonyms.replace(plain, codec) == (plain, {})
    assert pseudonyms.luhn(re.sub(r"\D", "", pseudonyms.replace("4111 1111 1111 1111", codec)[0]))
    assert date.fromisoformat(pseudonyms.replace("2020-02-29", codec)[0])
    df = docs(spark, [*ODD, "mail a@b.example.com"]).withColumn("pii", F.lit(1))
    got = pseudonyms.private(df, b"k")
    assert got.columns == df.columns and got.count() == len(ODD) + 1
    before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (df, got))
    assert all(before[i] == after[i] for i in range(len(ODD))) and before[len(ODD)] != after[len(ODD)]
    assert pseudonyms.private(docs(spark, []), b"k").count() == 0


def test_cards_and_ibans_before_numbers_and_words():
    codec = pseudonyms.Codec(b"k")
    rng = np.random.default_rng(8)

    def card(n):
        body = "".join(map(str, rng.integers(0, 10, n - 1)))
        return body + next(c for c in "0123456789" if pseudonyms.luhn(body + c))

    def groups(digits, sizes):
        return [digits[sum(sizes[:i]):sum(sizes[:i + 1])] for i in range(len(sizes))]

    cards = [c.join(groups(card(16), (4, 4, 4, 4))) for c in " -" for _ in range(40)] + [" ".join(groups(card(15), (4, 6, 5))) for _ in range(20)]
    cards += [card(16) for _ in range(20)] + ["4111 1111 1111 1111", "5555 5555 5555 4444"]
    for value in cards:
        alone = pseudonyms.replace(value, codec)[0]
        assert alone != value
        for text in ("%s 12/27", "%s 123", "%s 7 items", "%s 1", "%s-12", "no. 12 %s 123", "%s 555", "3 %s."):
            new = pseudonyms.replace(text % value, codec)[0]
            assert new == text % alone, (text, value)
            assert pseudonyms.replace(new, codec, False)[0] == text % value
    for value in (" ".join(groups(card(19), (4, 4, 4, 4, 3))) for _ in range(60)):
        new, found = pseudonyms.replace(value, codec)
        assert found == {"card": 1} and new[:19] != value[:19] and pseudonyms.replace(new, codec, False)[0] == value
    for value in ("BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "NO93 8601 1117 947", "AT61 1904 3002 3457 3201"):
        alone = pseudonyms.replace(value, codec)[0]
        assert alone != value
        for text in ("%s EUR", "%s PAID NOW", "%s A", "%s CURRENTLY", "%s 100 EUR", "%s 2024", "%s AB12 CD34", "%s Paid", "IBAN %s BIC"):
            new = pseudonyms.replace(text % value, codec)[0]
            assert new == text % alone, (text, value)
            assert pseudonyms.replace(new, codec, False)[0] == text % value


# 9, decontamination

def slow_hits(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, ids = words(text), set(), set()
    for i, t in items:
        x = words(t)
        m = min(10, len(x))
        for k in range(len(x) - m + 1 if m else 0):
            for p in range(len(w) - m + 1):
                if w[p:p + m] == x[k:k + m]:
                    hit |= set(range(p, p + m))
                    ids.add(str(i))
    return len(w), len(hit), len(ids), sorted(ids)


@pytest.mark.parametrize("block", [64, 1])
def test_decontamination_equals_brute_force(spark, block):
    rng = np.random.default_rng(9)
    pool = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(pool, n))) for i, n in enumerate([30, 12, 10, 9, 5, 4, 1, 25, 40])] + [(20, None), (21, ""), (22, "a a a a a a a a a a a a"), (0, "zz yy")]
    items[6] = (6, "solo")
    texts = [" ".join(rng.choice(pool, rng.integers(0, 60))) for _ in range(40)]
    for k in range(20):
        x = items[k % 9][1].split()
        i = int(rng.integers(0, len(x)))
        texts.append(" ".join([*rng.choice(pool, 5), *x[i:i + int(rng.integers(8, 15))], "SOLO" if k % 3 else "a " * 15, *rng.choice(pool, 5)]).replace(" ", rng.choice([" ", "--", "\n"])))
    texts += [None, "", "W1", items[0][1].upper(), items[0][1] + " " + items[0][1]]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = docs(spark, texts).withColumn("HITS", F.lit(0))
    got = {r["doc_id"]: r for r in decontaminate.contaminate(df, bench, together=block).collect()}
    for i, t in enumerate(texts):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["items"]) == slow_hits(t, items), i
    assert decontaminate.contaminate(df, bench.where("false")).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.clean(docs(spark, []), bench).count() == 0


def test_winnowing_finds_every_long_shared_span():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.integers(0, 6, 40).astype(np.uint64)
        kept = {int(a[i]): 0 for i in decontaminate.winnow(a, 6)}
        assert all(min(a[i:i + 6].tolist()) in kept for i in range(35))


# 10, mixing

def test_targets():
    assert mixing.targets({"a": 10, "b": 100}, {"a": 3, "b": 1}, 1.5, 2) == {"a": 20.0, "b": 145.0}
    assert mixing.targets({}, {}, 1.5, 2) == {} and mixing.targets({"a": 0}, {"a": 1}, 1.5, 2) == {"a": 0.0}


def test_flow_is_cheapest():
    # The shared pattern serves b, so that a's own words are used before anything is repeated.
    got = mixing.flow({"a": 10, "ab": 10, "b": 0}, {"a": ["a"], "ab": ["a", "b"], "b": ["b"]}, {"a": 10, "b": 10})
    assert got == {("a", "a"): 10, ("ab", "a"): 0, ("ab", "b"): 10, ("b", "b"): 0}
    short = mixing.flow({"a": 5}, {"a": ["a"]}, {"a": 50})
    assert short == {("a", "a"): 10}


def test_mix(spark):
    rows = [(i if i % 10 else None, "w " * (i % 50), [f"s{i % 3}"] if i % 3 else [None], "clash") for i in range(900)] + [(5, "x " * 9, [], ""), (6, None, ["s1"], "")] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, sources array<string>, taken string")
    taken, sources = mixing.mix(df, F.col("sources"))
    got, again = (Counter(map(tuple, mixing.mix(df.repartition(n), F.col("sources"))[0].select("key", "size", "pattern", "taken").collect())) for n in (1, 5))
    assert got == again and sum(got.values()) == len(rows)
    assert all(0 <= t <= 2 * s for (_, s, _, t) in got)
    by = Counter()
    for (_, _, p, t), n in got.items():
        by[p] += t * n
    for r in sources.collect():
        assert abs(by[f'["{r["source"]}"]' if r["source"] else "[null]"] - r["target"]) <= 1
    kept = mixing.mixed(df, F.col("sources"))
    assert kept.columns == ["doc_id", "text", "sources", "taken"] and kept.where("taken <= 0").count() == 0
    assert mixing.mixed(df.where("false"), F.col("sources")).count() == 0


def test_a_template_costs_few_pairs_of_texts(spark, monkeypatch):
    """Texts that share most of their words and are no copies: no pair of them is a row, and hardly any two are compared."""
    rng = np.random.default_rng(9)
    shared = [f"shared{i}" for i in range(100)]
    texts = [" ".join(shared + [f"own{rng.integers(1 << 40)}" for _ in range(40)]) for _ in range(300)]
    texts += [" ".join(t.split()[:-1]) for t in texts[:20]]
    looked = []
    monkeypatch.setattr(nearcopies, "_TILE", 32)
    alike = nearcopies._alike
    monkeypatch.setattr(nearcopies, "_alike", lambda pairs, *rest: (looked.append(pairs.count()), alike(pairs, *rest))[1])
    kept = {r["doc_id"] for r in nearcopies.one_of_each(docs(spark, texts)).select("doc_id").collect()}
    assert kept == set(range(300))
    assert sum(looked) < 0.02 * 320 * 319 / 2


def test_sketches_of_copies_agree():
    """At the limit no pair of 400 comes near the number of equal bytes that is asked for."""
    rng = np.random.default_rng(10)
    need = nearcopies.agreement()
    for size in (60, 300, 1000):
        for _ in range(133):
            words = [str(x) for x in rng.integers(0, 1 << 40, size)]
            other = list(words)
            i = 0
            while True:
                other[int(rng.integers(size))] = f"x{i}"
                i += 1
                a, b = (nearcopies.shingles(" ".join(w).encode()) for w in (words, other))
                if not nearcopies.similar(a, b):
                    break
                same = (nearcopies.minima(a).astype(np.uint8) == nearcopies.minima(b).astype(np.uint8)).sum()
                assert same > need
