"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm import (decontaminate, html, kernel, language, lm, mixing, pseudonyms, resampling, rules, simhash, spelling, toxicity,
                           warc)
from gustline.storage import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: str, by: int) -> Column:
    """crc32 of the key as text; a null key has remainder -1, so it belongs to no held-out part."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % by, F.lit(-1))


@query("op1_quality_rules")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    stats = materialize(rules.statistics(table(spark, folder, "documents")), "stats")
    found = rules.fit(stats, table(spark, folder, "labels"))
    return rules.apply(stats, found).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, folder, "labels"), ~held)
    return toxicity.score(docs, model).withColumn("held_out", held).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")).select("doc_id", "held_out", "score", "predicted", "n_windows")


_OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
m AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, m WHERE len(w) >= m)),
h AS (SELECT dw.r, dw.i, dw.m, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.m = bw.m),
n AS (
  SELECT r, count(DISTINCT j) AS n_hit
  FROM (SELECT DISTINCT r, unnest(generate_series(i, i + m - 1)) AS j FROM h) GROUP BY r),
s AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN s USING (r)
"""


@query("op9_decontamination", _OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query("op7_simhash")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op6_language_id")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = remainder("doc_id", 4) == 2
    found = language.identify(docs, language.fit(docs, ~held), keep=["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("lang_spans").cast("bigint").alias("n_spans"))


#: Production keys come from a secret store; the registered query needs the same pseudonyms in every run.
PSEUDONYM_KEY = b"gustline pseudonyms, registered query"


@query("op8_pii")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = pseudonyms.pseudonymize(table(spark, folder, "documents"), PSEUDONYM_KEY, keep=["doc_id"])
    counts = [F.coalesce(F.col("pii")[kind], F.lit(0)).cast("bigint").alias(f"n_{kind}") for kind, _, _ in pseudonyms.KINDS]
    return found.select("doc_id", "text", *counts)


@query("op10_mixing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    taken, sources = mixing.mix(table(spark, folder, "documents"), F.array("source"))
    named = taken.withColumn("source", F.from_json("pattern", "array<string>")[0])
    return named.join(sources, named["source"].eqNullSafe(sources["source"]), "left").select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op3_html_text")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = html.articles(table(spark, folder, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"), "path")


_OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
r AS (SELECT page_id, strlen(body) AS n, sha1(body) AS digest, max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM r
"""


@query("op4_warc", _OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.archive(table(spark, folder, "pages"), path)
    back = warc.read(spark, path)
    # Length and digest of a response are taken from the payload that was read back.
    full = F.col("warc_type") == "response"
    return back.select(
        warc.key_of("record_id").cast("bigint").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"), warc.key_of("refers_to").cast("bigint").alias("refers_to"))


@query("op5_lm_score")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = remainder("doc_id", 5) == 1
    return lm.score(docs, ~held).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: CRC-32 of the text ``x``, by a table made from its polynomial.
_CRC_TABLE = """
SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
         lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
"""
_CRC = """
xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(strlen(x)),
  lambda i: CAST('0x' || substr(hex(x), 2 * i + 1, 2) AS BIGINT))),
  lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)))
"""

_OP11_SQL = rf"""
WITH RECURSIVE crc AS MATERIALIZED ({_CRC_TABLE}),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
        FROM documents)
  GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_CRC} AS h FROM (SELECT run, n, concat(doc_id, ':', run) AS x FROM runs), crc),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
best AS (
  SELECT word, n_near, other, other_n
  FROM (SELECT word, other, n AS other_n, count(*) OVER (PARTITION BY word) AS n_near,
               row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS k FROM near)
  WHERE k = 1),
forms AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * words.n THEN other END AS form,
         CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
steps AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL SELECT forms.word, steps.root FROM forms JOIN steps ON forms.form = steps.word)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN steps USING (word)
"""


@query("op11_spelling_variants", _OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def _features_sql(name: str, key: str) -> str:
    """Runs of one to three words of a table's texts, one row each."""
    return rf"""
  SELECT r, key, n_words, unnest(flatten([
           w, list_transform(range(1, n_words), lambda i: w[i] || ' ' || w[i + 1]),
           list_transform(range(1, n_words - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])])) AS x
  FROM (SELECT *, len(w) AS n_words
        FROM (SELECT row_number() OVER () AS r, {key} AS key, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {name}))"""


_OP12_SQL = rf"""
WITH crc AS MATERIALIZED ({_CRC_TABLE}),
d AS MATERIALIZED ({_features_sql("documents", "doc_id")}),
b AS MATERIALIZED ({_features_sql("benchmark", "item_id")}),
buckets AS MATERIALIZED (
  SELECT x, {_CRC} % 10000 AS bucket FROM (SELECT x FROM d UNION SELECT x FROM b), crc),
s AS (SELECT bucket, count(*) AS n FROM d JOIN buckets USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN buckets USING (x) GROUP BY bucket),
every AS (SELECT (SELECT count(*) FROM d) AS s, (SELECT count(*) FROM b) AS t),
gains AS (
  SELECT bucket, floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (every.s + 10000.0::DOUBLE)
                                 / ((CAST(coalesce(s.n, 0) AS DOUBLE) + 1) * (every.t + 10000.0::DOUBLE)))) AS gain
  FROM s FULL JOIN t USING (bucket), every),
weights AS (
  SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM d JOIN buckets USING (x) JOIN gains USING (bucket) GROUP BY r),
rows AS (
  SELECT row_number() OVER () AS r, doc_id, len(regexp_extract_all(coalesce(text, ''),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS n_words,
         CAST('0x' || substr(sha256(concat('42:', doc_id)), 1, 8) AS BIGINT) AS h FROM documents),
scored AS (
  SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM rows LEFT JOIN weights USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
         5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS most
  FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= most THEN place END AS rank
FROM ranked
"""


@query("op12_importance_resampling", _OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_quality_classifier")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    held = remainder("doc_id", 4) == 2
    stats = materialize(kernel.statistics(table(spark, folder, "documents")), "statistics")
    model = kernel.fit(stats, table(spark, folder, "labels"), ~held)
    return kernel.score(stats, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
