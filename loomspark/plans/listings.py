"""List queries: orders stand for offers, customers for organisations, nations for institutions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import offer_name
from ..operators import engagement as E
from ..operators import listing as L
from .registry import query, read

AS_OF = "2001-05-01"

OFFERS_SQL = """offers AS (
  SELECT o_orderkey AS id, concat(o_orderpriority, ' ', c_name) AS name, concat('Org ', n_name) AS organisation, CAST(o_orderdate AS DATE) AS apply_end_date,
         o_orderstatus = 'O' AS is_recommended, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 5 AS INTEGER) END AS sort_order,
         o_orderstatus <> 'P' AS is_verified, o_custkey AS custkey, CAST(round(o_totalprice) AS BIGINT) AS view_count
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of offers."""
    orders, customer, nation = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("o_orderkey").alias("id"), F.concat_ws(" ", "o_orderpriority", "c_name").alias("name"), F.concat(F.lit("Org "), "n_name").alias("organisation"), F.to_date("o_orderdate").alias("apply_end_date"),
        (F.col("o_orderstatus") == "O").alias("is_recommended"), F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 3 != 0), (F.col("o_orderkey") % 5).cast("int")).alias("sort_order"),
        (F.col("o_orderstatus") != "P").alias("is_verified"), F.col("o_custkey").alias("custkey"), F.round("o_totalprice").cast("bigint").alias("view_count"),
    )


def home(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = offers(spark, sf_dir).where(F.col("is_verified") & (F.col("apply_end_date") >= F.lit(AS_OF).cast("date")))
    names = read(spark, sf_dir, "nation")
    return L.without_names(own, F.concat_ws(" ", "name", "organisation"), names, "n_name", 9)


HOME_SQL = f"""WITH {OFFERS_SQL}, home AS (
  SELECT * FROM offers o WHERE is_verified AND apply_end_date >= DATE '{AS_OF}' AND NOT EXISTS (
    SELECT 1 FROM nation u WHERE length(trim(n_name)) >= 9 AND position(lower(trim(n_name)) IN lower(o.name || ' ' || o.organisation)) > 0)),
scraps AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
ranked AS (SELECT home.*, coalesce(n, 0) AS scrap_count, CAST(row_number() OVER (ORDER BY is_recommended DESC, sort_order ASC NULLS LAST, apply_end_date, id) AS INTEGER) AS rn FROM home LEFT JOIN scraps ON id = l_orderkey)"""


def home_order() -> list:
    return [F.col("is_recommended").desc(), F.asc_nulls_last("sort_order"), F.asc("apply_end_date"), F.asc("id")]


@query(HOME_SQL + " SELECT rn, id, name, organisation, apply_end_date, is_recommended, coalesce(sort_order, -1) AS sort_order, scrap_count FROM ranked WHERE rn > 24 AND rn <= 48")
def home_page(spark, sf_dir):
    rows = L.page(home(spark, sf_dir), 2, None, *home_order())
    counted = L.with_counts(rows, "id", read(spark, sf_dir, "lineitem"), "l_orderkey", few=True)
    return counted.select("rn", "id", "name", "organisation", "apply_end_date", "is_recommended", F.coalesce("sort_order", F.lit(-1)).alias("sort_order"), "scrap_count")


@query(HOME_SQL + """ SELECT 1 AS page, 24 AS page_size, (SELECT count(*) FROM home) AS total_count,
  coalesce((SELECT string_agg(concat(rn, ':', id, ':', name), ',' ORDER BY rn) FROM ranked WHERE rn <= 24), '') AS items""")
def home_page_object(spark, sf_dir):
    page = L.page_object(home(spark, sf_dir), 1, 24, ["id", "name"], *home_order())
    items = F.array_join(F.transform("rows", lambda r: F.concat_ws(":", r["rn"].cast("string"), r["id"].cast("string"), r["name"])), ",")
    return page.select("page", "page_size", "total_count", items.alias("items"))


@query("SELECT l_orderkey AS id, count(*) AS scrap_count FROM lineitem WHERE l_orderkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1")
def scrap_counts(spark, sf_dir):
    wanted = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    log = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")).join(wanted, "id", "left_semi")
    return log.groupBy("id").agg(F.count(F.lit(1)).alias("scrap_count"))


@query("""SELECT l_suppkey AS user_id, count(*) AS n_urgent FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-07' GROUP BY 1""")
def urgent_bookmarks(spark, sf_dir):
    soon = F.to_date("o_orderdate").between(F.lit("1998-06-01").cast("date"), F.lit("1998-06-07").cast("date"))
    due = read(spark, sf_dir, "orders").where(soon).select("o_orderkey")
    return read(spark, sf_dir, "lineitem").join(due, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("l_suppkey").alias("user_id")).agg(F.count(F.lit(1)).alias("n_urgent"))


@query("SELECT p_partkey AS id, p_name AS name FROM part WHERE contains(lower(p_name), 'ed w') OR contains(lower(p_brand), 'ed w')")
def search_items(spark, sf_dir):
    found = L.searched(read(spark, sf_dir, "part"), " ED w ", "p_name", "p_brand")
    return found.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


@query("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE contains(lower(n_name), 'n_1')")
def admin_search(spark, sf_dir):
    found = L.admin_search(read(spark, sf_dir, "nation"), "n_1", "n_name")
    return found.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


@query("""SELECT o_orderkey AS id, o_totalprice AS price, o_orderdate AS created FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 400000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') ORDER BY created DESC, id LIMIT 20 OFFSET 20""")
def filtered_listing(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 400000) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return rows.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("created")).orderBy(F.desc("created"), "id").offset(20).limit(20)


@query("SELECT o_orderstatus AS status, count(*) AS n_rows, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM orders GROUP BY 1")
def full_scan(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_id"), F.max("o_orderkey").alias("last_id"))


@query("SELECT o_orderkey AS id, o_custkey AS custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9900)")
def lookup_in(spark, sf_dir):
    rich = read(spark, sf_dir, "customer").where("c_acctbal > 9900").select(F.col("c_custkey").alias("o_custkey"))
    return read(spark, sf_dir, "orders").join(rich, "o_custkey", "left_semi").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("custkey"))


def sorted_sql(order: str) -> str:
    return f"""WITH {OFFERS_SQL}, listed AS (SELECT offers.*, custkey % 11 = 0 AS is_bookmarked FROM offers WHERE apply_end_date >= DATE '2001-07-01')
SELECT id, CAST(row_number() OVER (ORDER BY is_recommended DESC, CASE WHEN is_recommended THEN sort_order END ASC NULLS LAST, {order}, id) AS INTEGER) AS rn FROM listed"""


def sorted_list(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    rows = offers(spark, sf_dir).where(F.col("apply_end_date") >= F.lit("2001-07-01").cast("date"))
    rows = rows.withColumn("sort_order", F.when(F.col("is_recommended"), F.col("sort_order"))).withColumn("is_bookmarked", F.col("custkey") % 11 == 0)
    keys = L.sort_keys(mode, "apply_end_date", "apply_end_date", "view_count", "custkey", "is_recommended", "sort_order", "is_bookmarked", "id")
    return L.ranked(rows, *keys).select("id", "rn")


@query(sorted_sql("is_bookmarked DESC, apply_end_date"))
def sort_by_deadline(spark, sf_dir):
    return sorted_list(spark, sf_dir, "deadline")


@query(sorted_sql("apply_end_date DESC"))
def sort_by_latest(spark, sf_dir):
    return sorted_list(spark, sf_dir, "latest")


@query(sorted_sql("view_count DESC"))
def sort_by_views(spark, sf_dir):
    return sorted_list(spark, sf_dir, "views")


@query(sorted_sql("custkey DESC"))
def sort_by_scraps(spark, sf_dir):
    return sorted_list(spark, sf_dir, "scraps")


ADS_SQL = """WITH RECURSIVE r AS (SELECT c_nationkey AS list, c_custkey AS id, c_custkey % 6 = 5 AS ad, c_custkey // 7 % 11 AS place FROM customer), a AS (SELECT *, row_number() OVER (PARTITION BY list ORDER BY place, id) AS nth FROM r WHERE ad AND place > 0),
base AS (SELECT list, coalesce(list(id ORDER BY id) FILTER (WHERE NOT (ad AND place > 0)), []) AS ids FROM r GROUP BY 1),
walk AS (SELECT list, ids, CAST(0 AS BIGINT) AS nth FROM base UNION ALL SELECT w.list, list_concat(list_append(w.ids[1:a.place - 1], a.id), w.ids[a.place:]), a.nth FROM walk w JOIN a ON a.list = w.list AND a.nth = w.nth + 1),
done AS (SELECT list, arg_max(ids, nth) AS ids FROM walk GROUP BY 1)
SELECT list, unnest(range(len(ids))) AS position, unnest(ids) AS id FROM done"""


@query(ADS_SQL)
def ads_in_lists(spark, sf_dir):
    key = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("list"), key.alias("id"), (key % 6 == 5).alias("ad"), F.expr("c_custkey DIV 7 % 11").alias("place"))
    return L.place_ads(rows.withColumn("position", F.col("id")), "list", "position", "id", "ad", "place")


@query(f"""SELECT CAST(o_orderdate AS DATE) AS apply_end_date, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS items, count(*) AS n_items,
  CAST(CAST(o_orderdate AS DATE) - DATE '{AS_OF}' AS INTEGER) AS days_left, CAST(o_orderdate AS DATE) - DATE '{AS_OF}' BETWEEN 0 AND 6 AS is_urgent
FROM orders GROUP BY o_orderdate""")
def bookmark_calendar(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").withColumn("apply_end_date", F.to_date("o_orderdate"))
    days = E.calendar(rows, "apply_end_date", "o_orderkey", AS_OF)
    return days.withColumn("items", F.array_join(F.transform("items", lambda x: x.cast("string")), ","))


@query("""SELECT s_suppkey AS id, s_suppkey % 9 = 0 OR EXISTS (SELECT 1 FROM nation WHERE concat(s_name, CASE WHEN s_suppkey % 3 = 1 THEN ' at NATION 1' ELSE ' at NATIO 1' END) ILIKE '%' || trim(n_name) || '%') AS is_campus FROM supplier""")
def on_campus(spark, sf_dir):
    place = F.when(F.col("s_suppkey") % 3 == 1, " at NATION 1").otherwise(" at NATIO 1")
    rows = read(spark, sf_dir, "supplier").withColumn("text", F.concat("s_name", place))
    rows = rows.withColumn("limits", F.when(F.col("s_suppkey") % 9 == 0, F.array(F.lit("x"))))
    return L.on_campus(rows, "limits", ["text"], read(spark, sf_dir, "nation"), "n_name").select(F.col("s_suppkey").alias("id"), "is_campus")


@query("""SELECT l_orderkey AS parent, l_linenumber AS child, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey) AS INTEGER) AS position
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'""")
def children_in_order(spark, sf_dir):
    from pyspark.sql import Window

    own = read(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey")
    rows = read(spark, sf_dir, "lineitem").join(own, F.col("l_orderkey") == F.col("o_orderkey"))
    order = Window.partitionBy("l_orderkey").orderBy(F.desc("l_shipdate"), "l_linenumber", "l_partkey")
    return rows.select(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("child"), F.row_number().over(order).alias("position"))


@query(r"""SELECT id, raw, coalesce(nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw,
  '[12]\s*학기|(?:19|20)\d{2}\s*[-.]\s*[12]\s*학기?', '', 'g'), '(?:19|20)\d{2}\s*(?:년(?:도)?|학년도)?', '', 'g'), '[\[(（]\s*[\])）]', '', 'g'),
  '\s*[-–—|·,/]\s*$', '', 'g'), '\s{2,}', ' ', 'g'), '^[\s\-–—|·,/]+|[\s\-–—|·,/]+$', '', 'g')), ''), raw) AS name FROM (
  SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN concat('2024학년도 ', p_name, ' 1학기') WHEN 1 THEN concat(p_name, ' (2023년)') WHEN 2 THEN '2024' WHEN 3 THEN concat('- ', p_name, ' |') ELSE p_name END AS raw FROM part)""")
def offer_names(spark, sf_dir):
    k, n = F.col("p_partkey") % 5, F.col("p_name")
    raw = F.when(k == 0, F.concat(F.lit("2024학년도 "), n, F.lit(" 1학기"))).when(k == 1, F.concat(n, F.lit(" (2023년)"))).when(k == 2, "2024").when(k == 3, F.concat(F.lit("- "), n, F.lit(" |"))).otherwise(n)
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), raw.alias("raw")).withColumn("name", offer_name(F.col("raw")))
