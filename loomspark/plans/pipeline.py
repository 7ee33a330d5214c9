"""Notice-pipeline queries: pages and documents stand for crawled rows, their ids for the order in which they came."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import keys, urls
from ..functions import text as T
from ..functions.dates import in_lookback, not_ended, parse_date
from ..functions.html import strip_tags
from ..operators import containment as H
from ..operators import notices as N
from .registry import query, read

TITLE_SQL = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '<[^>]+>', ' ', 'g'), '&amp;', '&', 'g'), '\s+', ' ', 'g'))"
ROWS_SQL = rf"""rows AS (
  SELECT page_id AS id, split_part(split_part(url, '/', 3), '.', 1) AS source, CASE WHEN page_id % 17 = 0 THEN '' WHEN page_id % 19 = 0 THEN 'Ab c' ELSE {TITLE_SQL} END AS title,
    CASE WHEN page_id % 23 = 0 THEN '' WHEN page_id % 29 = 0 THEN concat('ftp:', url) WHEN page_id % 31 = 0 THEN 'https://x.example.com/notice/list?page=2' WHEN page_id % 4 = 3 THEN concat('https://h.example.com/p/', page_id % 40 + 1000) ELSE replace(url, 'http://', 'https://') END AS link
  FROM pages)"""
REASON_SQL = r"""CASE WHEN title = '' THEN 'empty_title' WHEN link = '' THEN 'empty_url' WHEN NOT regexp_matches(link, '(?i)^https?://') THEN 'invalid_url' WHEN regexp_matches(link, '(?i)^http://') THEN 'insecure_http_url'
  WHEN length(regexp_replace(title, '\s+', '', 'g')) <= 6 THEN 'too_short_title' WHEN link = 'https://x.example.com/notice/list?page=2' THEN 'not_detail_notice_url' END"""


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as crawled rows, some of them spoilt in ways that the rules are about."""
    k, url = F.col("page_id"), F.col("url")
    title = F.when(k % 17 == 0, "").when(k % 19 == 0, "Ab c").otherwise(strip_tags(F.regexp_extract("html", "<h1>(.*?)</h1>", 1)))
    link = (
        F.when(k % 23 == 0, "").when(k % 29 == 0, F.concat(F.lit("ftp:"), url)).when(k % 31 == 0, "https://x.example.com/notice/list?page=2")
        .when(k % 4 == 3, F.concat(F.lit("https://h.example.com/p/"), (k % 40 + 1000).cast("string"))).otherwise(F.regexp_replace(url, "http://", "https://"))
    )
    source = F.substring_index(F.element_at(F.split(url, "/"), 3), ".", 1)
    return read(spark, sf_dir, "pages").select(k.alias("id"), source.alias("source"), title.alias("title"), link.alias("link"))


CLEAN_SQL = f"""WITH {ROWS_SQL}, judged AS (SELECT *, {REASON_SQL} AS r FROM rows),
nth AS (SELECT *, row_number() OVER (PARTITION BY source, link, r IS NULL ORDER BY id) AS n FROM judged),
cleaned AS (SELECT id, source, title, link, CASE WHEN r IS NULL AND n > 1 THEN 'duplicate_notice' ELSE r END AS reason FROM nth)"""


@query(CLEAN_SQL + " SELECT id, source, coalesce(reason, 'kept') AS reason FROM cleaned")
def clean_reject(spark, sf_dir):
    return N.classify(rows(spark, sf_dir), "source", "title", "link", "id").select("id", "source", F.coalesce("reason", F.lit("kept")).alias("reason"))


@query(CLEAN_SQL + " SELECT coalesce(reason, 'kept') AS reason, count(*) AS n_rows FROM cleaned GROUP BY 1")
def reject_counts(spark, sf_dir):
    return clean_reject(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query(rf"""WITH {ROWS_SQL} SELECT id, regexp_matches(title, '(?i)Scholarship\s*/?\s*Job') AS menu_like, length(regexp_replace(title, '\s+', '', 'g')) <= 6 AS very_short,
  regexp_matches(title, 'ScholarshipScholarship') AS odd_english, NOT regexp_matches(link, '(?i)mode=view|articleNo=|artclView\.do|uid=\d+|mod=document') AS no_detail, regexp_matches(link, '(?i)^http://') AS insecure FROM rows""")
def title_audit(spark, sf_dir):
    return N.audit(rows(spark, sf_dir), "title", "link").select("id", "menu_like", "very_short", "odd_english", "no_detail", "insecure")


@query(f"WITH {ROWS_SQL} SELECT id, source, link FROM (SELECT *, row_number() OVER (PARTITION BY source, link ORDER BY id) AS n FROM rows) WHERE n = 1")
def first_wins(spark, sf_dir):
    return N.first_wins(rows(spark, sf_dir), ["source", "link"], "id").select("id", "source", "link")


@query("""SELECT doc_id AS id, concat(source, CASE WHEN doc_id % 3 = 0 THEN concat(':native:', doc_id) WHEN doc_id % 3 = 1 THEN concat(':url:', substr(sha256(concat('https://', lower(source), '.example.com/d/', doc_id)), 1, 20))
  ELSE concat(':title-date:', substr(sha256(concat('doc ', lang, '|2024-01-0', doc_id % 9 + 1)), 1, 20)) END) AS canonical_key FROM documents""")
def canonical_keys(spark, sf_dir):
    k = F.col("doc_id")
    url = F.when(k % 3 == 1, F.concat(F.lit("HTTPS://"), "source", F.lit(".example.com/d/"), k.cast("string"), F.lit("#top")))
    native = F.when(k % 3 == 0, F.concat(F.lit(" "), k.cast("string")))
    key = keys.canonical_key(F.col("source"), native, url, F.concat(F.lit("Doc  "), F.upper("lang")), F.concat(F.lit("2024-01-0"), (k % 9 + 1).cast("string"), F.lit("T00:00")))
    return read(spark, sf_dir, "documents").select(k.alias("id"), key.alias("canonical_key"))


@query(r"""SELECT id, substr(sha256(concat('{"title":"', title, '","posted_at":', CASE WHEN id % 2 = 0 THEN '"2024-01-05"' ELSE 'null' END, ',"body_text":"', body, '"}')), 1, 32) AS content_hash
FROM (SELECT doc_id AS id, concat('Doc ', doc_id) AS title, regexp_replace(text, '[^A-Za-z]+', '', 'g') AS body FROM documents)""")
def content_hashes(spark, sf_dir):
    k = F.col("doc_id")
    body = F.regexp_replace("text", "[^A-Za-z]+", "")
    found = keys.content_hash(F.concat(F.lit("Doc "), k.cast("string")), F.when(k % 2 == 0, "2024-01-05 10:00"), body)
    return read(spark, sf_dir, "documents").select(k.alias("id"), found.alias("content_hash"))


@query("SELECT page_id AS id, md5(url) AS url_key, substr(sha256(concat('[\"https://a.example.com/', page_id, '\",\"https://b.example.com/\"]')), 1, 20) AS assets FROM pages")
def url_keys(spark, sf_dir):
    links = F.array(F.concat(F.lit("https://a.example.com/"), F.col("page_id").cast("string"), F.lit("#x")), F.lit(" https://B.example.com "))
    return read(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), keys.url_key(F.col("url")).alias("url_key"), keys.asset_fingerprint(links).alias("assets"))


DUP_SQL = f"WITH {ROWS_SQL}, groups AS (SELECT link AS key, count(*) AS n_rows, string_agg(DISTINCT source, '|' ORDER BY source) AS sources, count(DISTINCT source) AS n_sources FROM rows WHERE link <> '' GROUP BY 1 HAVING count(*) > 1)"


@query(DUP_SQL + " SELECT key, n_rows, sources FROM groups")
def duplicate_groups(spark, sf_dir):
    found = N.duplicate_groups(rows(spark, sf_dir), F.col("link"), {"sources": "source"})
    return found.withColumn("sources", F.array_join("sources", "|"))


@query(DUP_SQL + " SELECT key, n_rows, sources FROM groups WHERE n_sources > 1")
def cross_source_groups(spark, sf_dir):
    found = N.across_sources(N.duplicate_groups(rows(spark, sf_dir), F.col("link"), {"sources": "source"}), "sources")
    return found.withColumn("sources", F.array_join("sources", "|"))


@query("""WITH r AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, coalesce(l.quality, 0) AS priority FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT lang, source, count(*) AS n_rows, arg_max(doc_id, struct_pack(a := priority, b := -doc_id)) AS best_id FROM r GROUP BY 1, 2 HAVING count(*) > 1""")
def best_of_group(spark, sf_dir):
    joined = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left").withColumn("priority", F.coalesce("quality", F.lit(0)))
    return N.best_of(joined, ["lang", "source"], "priority", "doc_id", ["doc_id"]).withColumnRenamed("doc_id", "best_id")


@query("SELECT s_suppkey AS id, concat('src_', CASE WHEN rn < 1000 THEN lpad(rn::VARCHAR, 3, '0') ELSE rn::VARCHAR END) AS source_id FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS rn FROM supplier)")
def numbered_sources(spark, sf_dir):
    return N.numbered_ids(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")), "src", "id")


@query("SELECT doc_id AS id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 4")
def first_of_each(spark, sf_dir):
    return N.first_n(read(spark, sf_dir, "documents"), ["source"], "doc_id", 4).select(F.col("doc_id").alias("id"), "source")


@query("SELECT doc_id AS id, source FROM documents ORDER BY source, doc_id LIMIT 120")
def limit_over_sources(spark, sf_dir):
    return N.first_total(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source"), ["source", "id"], 120)


@query("SELECT o_orderkey AS id FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def unseen_rows(spark, sf_dir):
    fresh = N.unseen(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key")), "key", read(spark, sf_dir, "events"), "user_id")
    return fresh.select("id")


@query("SELECT 'customers' AS origin, c_nationkey AS nation, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS name FROM customer UNION ALL SELECT 'suppliers', s_nationkey, s_acctbal, s_name FROM supplier")
def tagged_union(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    b = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return N.tagged_union({"customers": a, "suppliers": b}, "origin").select("origin", "nation", "balance", "name")


@query("""SELECT nation, id, tier FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY tier, id) AS n FROM (
  SELECT s_nationkey AS nation, s_suppkey AS id, 1 AS tier FROM supplier UNION ALL SELECT c_nationkey, c_custkey, 2 FROM customer)) WHERE n = 1""")
def tiered_union(spark, sf_dir):
    a = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.lit(1).alias("tier"))
    b = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("id"), F.lit(2).alias("tier"))
    return N.tiered([a, b], "nation", "id")


HEALTH_SQL = """health AS (SELECT *, CASE WHEN h = 0 THEN 'healthy' WHEN h = 1 THEN 'partial' WHEN h = 2 THEN 'network_failed' WHEN h = 3 THEN 'pagination_incomplete' WHEN h = 4 THEN 'blocked' ELSE 'degraded' END AS run_quality
  FROM (SELECT source, CAST(substr(source, 4) AS INTEGER) % 7 AS h FROM documents GROUP BY source) WHERE h < 6)"""
VISIBLE_SQL = f"""WITH {HEALTH_SQL}, now AS (SELECT doc_id FROM documents WHERE crc % 5 > 0), judged AS (
  SELECT p.doc_id AS id, p.source, CASE WHEN n.doc_id IS NOT NULL THEN 'still_visible' WHEN run_quality IS NULL THEN 'needs_recheck' WHEN run_quality = 'network_failed' THEN 'missing_but_source_fetch_failed'
    WHEN run_quality = 'pagination_incomplete' THEN 'missing_but_pagination_incomplete' WHEN run_quality = 'blocked' THEN 'missing_but_source_blocked' WHEN run_quality = 'degraded' THEN 'missing_but_source_degraded' ELSE 'potentially_missing' END AS classification
  FROM documents p LEFT JOIN now n ON p.doc_id = n.doc_id LEFT JOIN health h ON p.source = h.source)""".replace("crc % 5", "doc_id % 5")


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.substring("source", 4, 9).cast("int") % 7
    state = F.when(h == 0, "healthy").when(h == 1, "partial").when(h == 2, "network_failed").when(h == 3, "pagination_incomplete").when(h == 4, "blocked").otherwise("degraded")
    own = read(spark, sf_dir, "documents").select("source").distinct().where(h < 6).withColumn("given", state)
    none, no = F.lit(None), F.lit(False)
    quality = D.run_quality(F.col("given"), no, none, none, none, no, none, none, none, no)
    out = own.withColumn("run_quality", quality).withColumns({"pagination_incomplete": no, "blocked_or_captcha": no})
    return out.withColumn("safe_for_change_detection", D.safe_for_changes(F.col("run_quality"))).withColumn("safe_for_missing_detection", D.safe_for_missing(F.col("run_quality"), no, no))


@query(VISIBLE_SQL + " SELECT id, source, classification, classification NOT IN ('still_visible', 'potentially_missing') AS keep FROM judged")
def visibility(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source")
    return N.visibility(docs, docs.where("id % 5 > 0"), health(spark, sf_dir), "id", "source").select("id", "source", "classification", "keep")


@query(f"""WITH {HEALTH_SQL} SELECT source, run_quality, run_quality IN ('healthy', 'partial') AS safe_for_change_detection, run_quality IN ('healthy', 'partial') AS safe_for_missing_detection FROM health""")
def source_health(spark, sf_dir):
    return health(spark, sf_dir).select("source", "run_quality", "safe_for_change_detection", "safe_for_missing_detection")


CHANGE_SQL = """WITH v AS (SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN lang END AS old_title, CASE WHEN doc_id % 6 = 0 THEN 'xx' ELSE lang END AS title, doc_id % 3 AS old_assets, doc_id % 4 AS assets,
  CASE doc_id % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'short' WHEN 2 THEN 'mixed' ELSE 'full' END AS old_quality, CASE doc_id % 7 WHEN 0 THEN 'empty' WHEN 1 THEN 'short' ELSE 'good' END AS quality FROM documents),
r AS (SELECT *, CASE old_quality WHEN 'empty' THEN 0 WHEN 'short' THEN 1 WHEN 'mixed' THEN 2 ELSE 3 END AS a, CASE quality WHEN 'empty' THEN 0 WHEN 'short' THEN 1 ELSE 3 END AS b FROM v),
f AS (SELECT id, concat_ws(',', CASE WHEN old_title <> title THEN 'title_changed' END, CASE WHEN b > a THEN 'body_quality_improved' END, CASE WHEN b < a THEN 'body_quality_degraded' END,
  CASE WHEN assets <> old_assets THEN 'asset_count_changed' END) AS flags FROM r)
SELECT id, CASE WHEN flags = '' THEN 'unchanged_content' ELSE flags END AS flags,
  CASE WHEN flags LIKE '%degraded%' THEN 'unsafe' WHEN flags LIKE '%title_changed%' OR flags LIKE '%asset_count%' THEN 'medium' ELSE 'low' END AS severity FROM f"""


@query(CHANGE_SQL)
def change_flags(spark, sf_dir):
    k = F.col("doc_id")
    none = {c: F.lit("") for c in ("published_at", "canonical_url", "content_hash", "asset_fingerprint", "warning_count", "error_count")}
    old_quality = F.when(k % 5 == 0, "empty").when(k % 5 == 1, "short").when(k % 5 == 2, "mixed").otherwise("full")
    quality = F.when(k % 7 == 0, "empty").when(k % 7 == 1, "short").otherwise("good")
    before = none | {"title": F.when(k % 2 == 0, F.col("lang")), "body_quality": old_quality, "asset_count": k % 3}
    now = none | {"title": F.when(k % 6 == 0, "xx").otherwise(F.col("lang")), "body_quality": quality, "asset_count": k % 4}
    found = read(spark, sf_dir, "documents").select(k.alias("id"), D.run_changes(now, before).alias("f"))
    return found.select("id", F.array_join("f", ",").alias("flags"), D.severity(F.col("f"), F.lit(True)).alias("severity"))


@query("""WITH v AS (SELECT doc_id AS id, concat_ws(',', CASE WHEN doc_id % 5 = 0 THEN 'title_changed' END, CASE WHEN doc_id % 7 = 0 THEN 'body_changed' END, CASE WHEN doc_id % 3 = 0 THEN 'url_alias_candidate' END, CASE WHEN doc_id % 11 = 0 THEN 'asset_count_changed' END) AS flags FROM documents)
SELECT id, flags, CASE flags WHEN '' THEN 'unchanged_candidate' WHEN 'url_alias_candidate' THEN 'url_alias_candidate' ELSE 'changed_candidate' END AS classification FROM v""")
def existing_compare(spark, sf_dir):
    k, lang = F.col("doc_id"), F.col("lang")
    own = F.concat(F.lit("https://x.example.com/"), k.cast("string"))
    other = F.concat(F.lit("https://y.example.com/"), k.cast("string"))
    now = {"title": lang, "content_hash": F.lit("a"), "body_text": lang, "canonical_url": own, "discovered_url": F.when(k % 3 == 0, other).otherwise(own), "asset_count": F.lit(1)}
    stored = {"title": F.when(k % 5 == 0, "old").otherwise(lang), "content_hash": F.when(k % 7 == 0, "b").otherwise("a"), "body_text": lang, "canonical_url": own, "asset_count": F.when(k % 11 == 0, 2).otherwise(1)}
    found = read(spark, sf_dir, "documents").select(k.alias("id"), D.existing_changes(now, stored, F.array(own)).alias("f"))
    return found.select("id", F.array_join("f", ",").alias("flags"), D.existing_class(F.col("f")).alias("classification"))


PLAN_SQL = """WITH it AS (SELECT o_orderkey AS id, CASE o_custkey % 4 WHEN 0 THEN 'unchanged_candidate' WHEN 1 THEN 'url_alias_candidate' WHEN 2 THEN 'changed_candidate' ELSE 'new_candidate' END AS cls,
  o_orderstatus = 'P' AS unsafe, count(l_orderkey) AS assets FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
ops AS (
  SELECT id, unnest(['insert_run', 'insert_source_result']) AS operation, false AS blocked, true AS review FROM it
  UNION ALL SELECT id, 'no_op_unchanged', false, false FROM it WHERE cls = 'unchanged_candidate'
  UNION ALL SELECT id, unnest(['add_url_alias', 'insert_occurrence']), false, true FROM it WHERE cls = 'url_alias_candidate'
  UNION ALL SELECT id, unnest(['update_notice_metadata', 'update_notice_body']), unsafe, true FROM it WHERE cls = 'changed_candidate'
  UNION ALL SELECT id, 'insert_notice', unsafe, true FROM it WHERE cls = 'new_candidate'
  UNION ALL SELECT id, 'skip_update_due_to_source_health', true, true FROM it WHERE unsafe
  UNION ALL SELECT id, unnest(['insert_occurrence', 'insert_notice_target', 'insert_keyword_match']), unsafe, unsafe FROM it
  UNION ALL SELECT id, 'insert_asset', unsafe, unsafe FROM it JOIN lineitem ON id = l_orderkey)"""


def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as notices with the operations that applying them would take; their lines are assets."""
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count(F.lit(1)).alias("assets"))
    k = F.col("o_custkey") % 4
    local = F.when(k == 0, "unchanged_candidate").when(k == 1, "url_alias_candidate").when(k == 2, "changed_candidate").otherwise("new_candidate")
    items = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), local.alias("local"), (F.col("o_orderstatus") != "P").alias("safe")).join(lines, "id", "left")
    empty = F.array().cast("array<string>")
    return items.withColumn("operations", N.write_operations(empty, F.col("local"), empty, F.col("safe"), F.lit(1), F.col("assets"), F.lit(False)))


@query(PLAN_SQL + " SELECT operation, count(*) AS n_operations, count(*) FILTER (WHERE blocked) AS n_blocked, count(*) FILTER (WHERE review) AS n_review FROM ops GROUP BY 1")
def write_plan(spark, sf_dir):
    return N.plan_summary(planned(spark, sf_dir), "operations")


@query(PLAN_SQL + """, sel AS (SELECT DISTINCT id, operation FROM ops WHERE NOT blocked AND NOT review),
need AS (SELECT s.*, p.parent FROM sel s JOIN (VALUES ('insert_occurrence', 'insert_run'), ('insert_occurrence', 'insert_notice'), ('insert_asset', 'insert_notice'), ('no_op_unchanged', 'insert_asset')) p(child, parent) ON s.operation = p.child)
SELECT n.id, n.operation, string_agg(n.parent, '|' ORDER BY n.parent) AS missing_parents FROM need n LEFT JOIN sel s ON s.id = n.id AND s.operation = n.parent WHERE s.id IS NULL GROUP BY 1, 2""")
def missing_parents(spark, sf_dir):
    each = planned(spark, sf_dir).select("id", F.explode("operations").alias("o")).where(~F.col("o.blocked") & ~F.col("o.review")).select("id", "o.operation")
    parents = {"insert_occurrence": ["insert_run", "insert_notice"], "insert_asset": ["insert_notice"], "no_op_unchanged": ["insert_asset"]}
    found = N.missing_parents(each, ["id"], "operation", parents)
    return found.withColumn("missing_parents", F.array_join("missing_parents", "|"))


@query(PLAN_SQL + """, why AS (SELECT id, operation, concat_ws('|', CASE WHEN blocked THEN 'operation_blocked' END, CASE WHEN review THEN 'requires_review' END) AS r FROM ops),
place AS (SELECT id, dense_rank() OVER (ORDER BY id) AS n FROM why WHERE r = '' GROUP BY id)
SELECT CASE WHEN r <> '' THEN r WHEN n > 500 THEN 'max_items_limit_reached' ELSE 'selected' END AS reasons, count(*) AS n_operations FROM why LEFT JOIN place USING (id) GROUP BY 1""")
def rehearsal_selection(spark, sf_dir):
    each = planned(spark, sf_dir).select("id", F.explode("operations").alias("o"))
    reasons = D.flags([(F.col("o.blocked"), "operation_blocked"), (F.col("o.review"), "requires_review")])
    found = N.selected(each.withColumn("reasons", reasons), "id", "id", "reasons", 500)
    shown = F.when(F.size("reasons") == 0, "selected").otherwise(F.array_join("reasons", "|"))
    return found.groupBy(shown.alias("reasons")).agg(F.count(F.lit(1)).alias("n_operations"))


@query("""SELECT p_partkey AS id, n_nationkey AS unit FROM (
  SELECT p_partkey, n_nationkey, row_number() OVER (PARTITION BY p_partkey ORDER BY pos, how) AS k FROM (
    SELECT v.p_partkey, v.pos, how, min(n_nationkey) AS n_nationkey FROM (
      SELECT p_partkey, 0 AS pos, concat(n1.n_name, '과') AS name FROM part JOIN nation n1 ON n1.n_nationkey = p_partkey % 40
      UNION ALL SELECT p_partkey, 1, concat('NATION_', p_partkey % 30) FROM part) v
    JOIN (SELECT 0 AS how, n_nationkey, n_name AS k FROM nation UNION ALL SELECT 1, n_nationkey, n_name FROM nation) u ON (u.how = 0 AND u.k = v.name) OR (u.how = 1 AND u.k = regexp_replace(v.name, '[과부]$', ''))
    GROUP BY 1, 2, 3 HAVING count(DISTINCT n_nationkey) = 1)) WHERE k = 1""")
def resolved_names(spark, sf_dir):
    nation = read(spark, sf_dir, "nation")
    named = read(spark, sf_dir, "part").join(nation, F.col("n_nationkey") == F.col("p_partkey") % 40, "left")
    variants = F.array_compact(F.array(F.concat("n_name", F.lit("과")), F.concat(F.lit("NATION_"), (F.col("p_partkey") % 30).cast("string"))))
    rows_ = named.select(F.col("p_partkey").alias("id"), F.lit("x").alias("scope"), variants.alias("variants"))
    units = nation.select(F.col("n_nationkey").alias("unit"), F.col("n_name").alias("name"), F.col("n_name").alias("stem"), F.lit("x").alias("scope"))
    return N.resolved_names(rows_, "id", "variants", "scope", units, "unit", "name", "stem", "scope", lambda c: F.regexp_replace(c, "[과부]$", ""))


@query("""WITH s AS (SELECT s_suppkey AS id, s_nationkey AS grp, s_suppkey % 3 AS college, s_suppkey % 5 = 0 AS broken, s_suppkey % 47 = 0 AS wide FROM supplier)
SELECT b.id, arg_min(o.id, struct_pack(a := CASE WHEN o.wide THEN 0 WHEN o.college = b.college THEN 1 ELSE 2 END, b := o.id)) AS fallback FROM s b JOIN s o ON b.grp = o.grp AND NOT o.broken AND b.id <> o.id WHERE b.broken GROUP BY 1""")
def fallback_sources(spark, sf_dir):
    k = F.col("s_suppkey")
    s = read(spark, sf_dir, "supplier").select(k.alias("id"), F.col("s_nationkey").alias("grp"), (k % 3).alias("college"), (k % 5 == 0).alias("broken"), (k % 47 == 0).alias("wide"))
    return N.fallback_source(s, "id", "grp", "college", "id", "broken", "wide")


@query("""SELECT id, other, other_name FROM (SELECT a.p_partkey AS id, b.p_partkey AS other, b.p_name AS other_name, row_number() OVER (PARTITION BY a.p_partkey ORDER BY length(b.p_name) DESC, b.p_partkey) AS n
  FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_partkey <> b.p_partkey AND (a.p_name ILIKE '%' || split_part(b.p_name, ' ', 1) || '%' OR split_part(b.p_name, ' ', 1) ILIKE '%' || a.p_name || '%')) WHERE n = 1""")
def fuzzy_distinct_on(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    a = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_brand", "p_type")
    b = part.select(F.col("p_partkey").alias("other"), F.col("p_name").alias("other_name"), "p_brand", "p_type").withColumn("word", F.substring_index("other_name", " ", 1))
    return H.longest_held(a, "id", "name", b, "other", "word", "other_name", ["p_brand", "p_type"])


@query("""SELECT doc_id AS id, keyword, CAST(strpos(lower(text), keyword) - 1 AS INTEGER) AS offset_start FROM documents, (SELECT unnest(['the', 'license', 'zzz', 'que']) AS keyword) WHERE strpos(lower(text), keyword) > 0""")
def keyword_offsets(spark, sf_dir):
    hits = T.keyword_hits({"text": F.col("text")}, ["the", "License", "zzz", "que"])
    each = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.explode(hits).alias("h"))
    return each.select("id", F.lower("h.keyword").alias("keyword"), F.col("h.offset_start").cast("int").alias("offset_start"))


@query("SELECT doc_id AS id FROM documents WHERE contains(lower(text), 'license') OR contains(lower(text), 'token')")
def keyword_filter(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(T.any_keyword(F.col("text"), ["LICENSE", "token"])).select(F.col("doc_id").alias("id"))


@query("SELECT event_id AS id FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-20' - 7 AND DATE '2024-01-20' OR event_type = 'error'")
def lookback_filter(spark, sf_dir):
    day = F.when(F.col("event_type") != "error", F.to_date("ts"))
    return read(spark, sf_dir, "events").where(in_lookback(day, F.lit("2024-01-20").cast("date"), 7, True)).select(F.col("event_id").alias("id"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) >= DATE '2000-01-01'")
def not_expired(spark, sf_dir):
    end = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    return read(spark, sf_dir, "orders").where(not_ended(end, F.lit("2000-01-01").cast("date"), False)).select(F.col("o_orderkey").alias("id"))


@query("SELECT c_custkey AS id FROM customer WHERE starts_with(c_name, 'Customer#00000') AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 2, 3)")
def source_filter(spark, sf_dir):
    keep = F.startswith(F.col("c_name"), F.lit("Customer#00000")) & F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.col("c_nationkey").isin(1, 2, 3)
    return read(spark, sf_dir, "customer").where(keep).select(F.col("c_custkey").alias("id"))


@query("""WITH it AS (SELECT doc_id AS id, length(trim(regexp_replace(t, '\\s+', ' ', 'g'))) AS n, q FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE text END AS t, CASE WHEN doc_id % 9 = 0 THEN 'Short body' ELSE 'full' END AS q FROM documents))
SELECT id, CASE WHEN n = 0 THEN 'empty_body' WHEN n < 80 OR q = 'Short body' THEN 'short_body' ELSE '' END AS quality_flags, CASE WHEN id % 10 = 0 THEN 'missing_title' ELSE '' END AS missing,
  CASE WHEN id % 10 = 0 THEN 'blocked_by_missing_required_field' WHEN id % 13 = 0 THEN 'duplicate_within_input' WHEN n < 80 OR q = 'Short body' THEN 'needs_quality_review' ELSE 'new_candidate' END AS local FROM it""".replace("\\\\s", "\\s"))
def item_quality(spark, sf_dir):
    k = F.col("doc_id")
    docs = read(spark, sf_dir, "documents").select(k.alias("id"), F.when(k % 4 == 0, "").otherwise(F.col("text")).alias("body"), F.when(k % 9 == 0, "Short body").otherwise("full").alias("q"))
    docs = docs.withColumn("qf", D.quality_flags(F.col("body"), F.col("q"))).withColumn("mf", D.missing_required(F.when(F.col("id") % 10 == 0, "").otherwise("t"), F.lit("https://x.example.com/a")))
    local = D.local_class(F.col("mf"), F.lit("healthy"), F.col("id") % 13 == 0, F.col("qf"))
    return docs.select("id", F.array_join("qf", ",").alias("quality_flags"), F.array_join("mf", ",").alias("missing"), local.alias("local"))


@query(r"""SELECT page_id AS id, regexp_replace(url, '#.*$', '') AS normal, regexp_matches(url, '(?i)^https?://') AS is_web, concat('https://', regexp_replace(url, '^https?://', '')) AS repaired FROM pages""")
def url_rules(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), urls.normalise(url).alias("normal"), urls.is_web(url).alias("is_web"), urls.repaired(url, F.lit("https://none.example/x")).alias("repaired"))


@query(r"""SELECT page_id AS id, regexp_matches(url, '(?i)[?&](no|idx|seq|id|uid)=\d+') AS likely, split_part(split_part(url, '/', 3), '.', -2) = 'example' AS same FROM pages""")
def detail_urls(spark, sf_dir):
    url = F.col("url")
    host = F.concat(F.lit("https://"), F.regexp_extract(url, r"(example\.[a-z]+)", 1), F.lit("/"))
    return read(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), urls.likely_detail(url).alias("likely"), urls.same_site(url, host).alias("same"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def parsed_dates(spark, sf_dir):
    k, d = F.col("o_orderkey") % 5, F.to_date("o_orderdate")
    text = (
        F.when(k == 0, F.date_format(d, "'posted' yyyy. M. d")).when(k == 1, F.concat(F.date_format(d, "yyyy"), F.lit("년 "), F.date_format(d, "M"), F.lit("월 "), F.date_format(d, "d"), F.lit("일")))
        .when(k == 2, F.date_format(d, "yyyy-MM-dd HH:mm")).when(k == 3, F.concat(F.date_format(d, "yyyy"), F.lit("/"), F.date_format(d, "MM/dd"))).otherwise("2024-13-45 no day")
    )
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), parse_date(text).alias("day"))
