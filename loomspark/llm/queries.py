"""The queries opN_<name> over the driver tables, and their SQL where SQL can say it.

Each is thin: it reads its whole table, calls its operator and derives the columns to return.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, clicks, hilbert, interactions, langid, line_dedup, mih, packing, pii, quality, repetition, secrets, simhash
from .common import remainder, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seen = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    scored = quality.score(docs, quality.learn(docs, seen))
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tok

    return packing.pack(table(spark, sf_dir, "documents"), tok.path("byte_bpe_50k.json"), rank_path=tok.path("byte_bpe_50k.tiktoken"), pattern=tok.PATTERN)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tok

    return secrets.scan(table(spark, sf_dir, "documents"), secrets.ready(tok.path("byte_bpe_50k.tiktoken")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tok

    return bpe.digests(table(spark, sf_dir, "documents"), tok.path("byte_bpe_multi_50k.tiktoken"), tok.PATTERN)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.rules(table(spark, sf_dir, "documents")).drop("longest_repeat")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.learn(docs.where(remainder(F.col("doc_id"), 4) != 2))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return mih.top_k(rows, rows.where(F.col("vec_id") % 50 == 0)).withColumnRenamed("query_id", "vec_id")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hilbert.assign(table(spark, sf_dir, "documents"), 8)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_click_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clicks.deduplicate(clicks.batched(table(spark, sf_dir, "clicks")))
    return found.select(*(c for c in found.columns if c != "digest"), F.lower(F.hex("digest")).alias("hash"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = interactions.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("part", "filter_order", F.col("step").cast("int").alias("step"), *(F.col(c).cast("bigint").alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_packing, op3_line_dedup, op4_secret_scan, op5_bpe, op6_quality_rules, op7_pii, op8_simhash, op9_language_id, op10_top_k, op11_sharding, op12_click_dedup, op13_filter_audit)}


LINES_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), 'without id ' || md5(coalesce(text, ''))) AS document, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, document, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs),
keyed AS (
  SELECT r, document, pos, line,
         translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT document) >= 10),
kept AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE c.key IS NOT NULL) AS n_dropped,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
  FROM keyed LEFT JOIN common c ON keyed.key = c.key GROUP BY r)
SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM docs JOIN kept USING (r)"""


TOP_K_SQL = """
WITH bits AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS b FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (
  SELECT q.vec_id, n.vec_id AS neighbour_id,
         CAST(len(list_filter(list_zip(q.b, n.b), lambda x: x[1] <> x[2])) AS INTEGER) AS distance
  FROM bits q JOIN bits n ON q.vec_id % 50 = 0 AND q.vec_id <> n.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM pairs)
SELECT vec_id, rank, neighbour_id, distance FROM ranked WHERE rank <= 10"""


RULES_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
n AS (SELECT *, len(words) AS n_words, 51 AS far FROM w),
sizes AS (SELECT doc_id, words, n_words, unnest([4, 8, far]) AS k, unnest(['c', 'r', 'f']) AS kind FROM n),
windows AS (SELECT doc_id, kind, k, words, unnest(range(1, n_words - k + 2)) AS i FROM sizes WHERE n_words >= k),
hashed AS (SELECT doc_id, kind, k, i, md5(array_to_string(list_slice(words, i, i + k - 1), ' ')) AS h FROM windows),
twice AS (SELECT doc_id, kind, k, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, kind, h) AS c FROM hashed) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) FILTER (WHERE kind = 'r') AS n_repeat_words, count(DISTINCT p) FILTER (WHERE kind = 'c') AS n_covered, bool_or(kind = 'f') AS far_repeat
  FROM (SELECT doc_id, kind, unnest(CASE WHEN kind = 'f' THEN [i] ELSE range(i, i + k) END) AS p FROM twice) GROUP BY 1),
lines AS (
  SELECT doc_id, sum(c - 1) AS n_dup_lines
  FROM (SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2) GROUP BY 1),
base AS (
  SELECT n.doc_id, n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_covered, 0) AS n_covered, coalesce(far_repeat, false) AS far_repeat
  FROM n LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_covered <= 0.35 * n_words AND NOT far_repeat AS kept, n_covered
FROM base"""


AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
least AS (SELECT text, min(doc_id) AS first FROM d GROUP BY 1),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
flags AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS INT)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(d.doc_id > first, false) AS INT) AS fails
  FROM d JOIN least USING (text) LEFT JOIN marks ON d.doc_id = marks.doc_id),
f AS (SELECT unnest(range(5)) AS f, unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.f, b.f, c.f, d.f, e.f] AS fs
  FROM f a JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f) JOIN f d ON d.f NOT IN (a.f, b.f, c.f) JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, fs[step] AS f, CAST(coalesce(list_sum(list_transform(fs[1:step - 1], lambda x: 1 << x)), 0) AS BIGINT) AS b
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
pairs AS (SELECT DISTINCT f, b FROM steps),
counts AS (
  SELECT part, f, b, count(*) FILTER (fails & (b | (1 << f)) = 0) AS kept, count(*) FILTER (fails & b = 0 AND fails & (1 << f) <> 0) AS removed,
    count(*) FILTER (fails & b <> 0 AND fails & (1 << f) <> 0) AS redundant, count(*) FILTER (fails = 1 << f) AS unique_fails,
    count(*) FILTER (fails & b = 0 AND fails & (1 << f) <> 0 AND good) AS good_lost, count(*) FILTER (fails & b = 0 AND fails & (1 << f) <> 0 AND toxic) AS toxic_lost
  FROM flags, pairs GROUP BY 1, 2, 3),
worth AS (SELECT part, f, CAST(sum(removed) AS BIGINT) AS shapley FROM counts JOIN steps USING (f, b) GROUP BY 1, 2)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley
FROM steps JOIN counts USING (f, b) JOIN worth USING (part, f)"""


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": LINES_SQL, "op6_quality_rules": RULES_SQL, "op10_top_k": TOP_K_SQL, "op13_filter_audit": AUDIT_SQL}
