"""Mart queries over the event log."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import seoul_date, within_seoul_days
from ..operators import engagement as E
from ..streaming import feed
from ..streaming import views as V
from .registry import query, read

KINDS = {"n_views": "view", "n_clicks": "click", "n_purchases": "purchase", "n_signups": "signup", "n_errors": "error"}
COUNTS_SQL = ", ".join(f"count(*) FILTER (WHERE event_type = '{v}') AS {k}" for k, v in KINDS.items())
DAY_SQL = "CAST(ts + INTERVAL 9 HOUR AS DATE)"
ITEM_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
AS_OF = "2024-01-24"


def events(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The event log (of some days) with its local day and its item."""
    item = F.get_json_object("props", "$.k").cast("int")
    log = read(spark, sf_dir, "events").where(within_seoul_days(F.col("ts"), first, last))
    return log.withColumn("day", seoul_date(F.col("ts"))).withColumn("item", item)


@query(f"SELECT {DAY_SQL} AS day, count(DISTINCT user_id) AS active_users, count(*) AS n_events, {COUNTS_SQL} FROM events GROUP BY 1")
def daily_kpi(spark, sf_dir):
    return E.daily_kpi(events(spark, sf_dir), "day", "user_id", "event_type", KINDS)


def fed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as it may come in: in four batches by a hash of the event, so events are late by any number of days, and every fifth
    of them a second time in a later batch."""
    log = events(spark, sf_dir).select("event_id", "user_id", "event_type", "day", "item")
    first = F.pmod(F.xxhash64("event_id"), F.lit(4)).cast("int")
    again = F.when(F.col("event_id") % 5 == 0, F.array(first, F.least(first + 1, F.lit(3)))).otherwise(F.array(first))
    return log.withColumn("batch", F.explode(again))


@query(f"SELECT {DAY_SQL} AS day, count(DISTINCT user_id) AS active_users, count(*) AS n_events, {COUNTS_SQL} FROM events GROUP BY 1")
def streamed_daily_kpi(spark, sf_dir):
    """The daily KPIs from a stream of late and repeated events over several starts: the same as those of the whole log."""

    def start(stream: DataFrame, base: str):
        feed.keep_versions(V.users_of_days(stream, "day", "user_id"), base, "users").awaitTermination()
        return feed.keep_versions(V.counts_of_days(stream, "day", KINDS), base, "counts")

    base = feed.played(fed(spark, sf_dir), "batch", start)
    users, counts = feed.latest(spark, base, "users", ["day"]), feed.latest(spark, base, "counts", ["day"])
    return counts.join(users, "day", "left").select("day", F.coalesce("active_users", F.lit(0)).alias("active_users"), "n_events", *KINDS)


@query(f"SELECT DISTINCT {ITEM_SQL} AS item FROM events WHERE {ITEM_SQL} IS NOT NULL")
def streamed_new_items(spark, sf_dir):
    """Items as they are seen for the first time, over several starts: each once."""
    rows = fed(spark, sf_dir).where(F.col("item").isNotNull()).select("item", "batch")
    base = feed.played(rows, "batch", lambda stream, at: feed.keep_versions(V.new_items(stream, "item"), at, "items", "append"))
    return spark.read.parquet(f"{base}/items").select("item")


@query(f"SELECT DATE '2024-03-01' AS day, count(DISTINCT user_id) AS active_users, count(*) AS n_events, {COUNTS_SQL} FROM events WHERE {DAY_SQL} = DATE '2024-03-01'")
def day_kpi_without_events(spark, sf_dir):
    return E.day_kpi(events(spark, sf_dir, "2024-03-01", "2024-03-01"), "day", "2024-03-01", "user_id", "event_type", KINDS)


@query(f"SELECT {DAY_SQL} AS day, {ITEM_SQL} AS item, count(DISTINCT user_id) AS active_users, {COUNTS_SQL} FROM events WHERE {ITEM_SQL} IS NOT NULL GROUP BY 1, 2")
def item_daily_kpi(spark, sf_dir):
    return E.item_kpi(events(spark, sf_dir), "day", "item", "user_id", "event_type", KINDS)


@query(f"""SELECT {DAY_SQL} AS day, concat('Term ', {ITEM_SQL}) AS term, count(*) AS n_searches
FROM events WHERE {ITEM_SQL} % 7 <> 0 GROUP BY 1, 2""")
def term_daily(spark, sf_dir):
    term = F.when(F.col("item") % 7 == 0, "  ").otherwise(F.concat(F.lit("Term "), F.col("item").cast("string")))
    return E.term_counts(events(spark, sf_dir).withColumn("term", term), "day", "term")


RETENTION_SQL = f"""
WITH days AS (SELECT DISTINCT user_id, {DAY_SQL} AS d FROM events WHERE {DAY_SQL} <= DATE '{AS_OF}'),
firsts AS (SELECT user_id, min(d) AS cohort_date FROM days GROUP BY 1),
joined AS (SELECT f.*, d.d - f.cohort_date AS k FROM firsts f JOIN days d USING (user_id)),
cohorts AS (
  SELECT cohort_date, count(DISTINCT user_id) AS cohort_size, count(DISTINCT user_id) FILTER (WHERE k = 1) AS d1_users,
         count(DISTINCT user_id) FILTER (WHERE k = 3) AS d3_users, count(DISTINCT user_id) FILTER (WHERE k = 7) AS d7_users
  FROM joined GROUP BY 1),
rated AS (SELECT *, round(100.0 * d1_users / cohort_size, 2)::DOUBLE AS d1_rate, round(100.0 * d3_users / cohort_size, 2)::DOUBLE AS d3_rate,
         round(100.0 * d7_users / cohort_size, 2)::DOUBLE AS d7_rate FROM cohorts)"""


@query(RETENTION_SQL + " SELECT * FROM rated")
def retention(spark, sf_dir):
    return E.retention(events(spark, sf_dir, last=AS_OF), "day", "user_id")


@query(
    RETENTION_SQL
    + " SELECT "
    + ", ".join(f"max_by(cohort_date, cohort_date) FILTER (WHERE cohort_date <= DATE '{AS_OF}' - {k}) AS d{k}_cohort, max_by(d{k}_rate, cohort_date) FILTER (WHERE cohort_date <= DATE '{AS_OF}' - {k}) AS d{k}_rate" for k in (1, 3, 7))
    + " FROM rated"
)
def latest_mature_cohorts(spark, sf_dir):
    return E.latest_mature(retention(spark, sf_dir), AS_OF)


@query(f"""WITH kpi AS (SELECT {DAY_SQL} AS day, count(DISTINCT user_id) AS active_users, count(*) AS n_events, count(*) FILTER (WHERE event_type = 'view') AS n_views FROM events GROUP BY 1)
SELECT CAST(sum(active_users) AS BIGINT) AS active_users, CAST(sum(n_events) AS BIGINT) AS n_events, CAST(sum(n_views) AS BIGINT) AS n_views
FROM kpi WHERE day BETWEEN DATE '{AS_OF}' - 6 AND DATE '{AS_OF}'""")
def week_totals(spark, sf_dir):
    week = events(spark, sf_dir, str(date.fromisoformat(AS_OF) - timedelta(6)), AS_OF)
    return E.sums(E.daily_kpi(week, "day", "user_id", "event_type", KINDS), ["active_users", "n_events", "n_views"])


@query(f"""WITH kpi AS (SELECT {DAY_SQL} AS day, {ITEM_SQL} AS item, count(*) FILTER (WHERE event_type = 'view') AS n_views FROM events GROUP BY 1, 2)
SELECT item, CAST(sum(n_views) AS BIGINT) AS n_views FROM kpi GROUP BY 1 ORDER BY n_views DESC, item LIMIT 10""")
def top_items(spark, sf_dir):
    return E.top(E.sums(item_daily_kpi(spark, sf_dir), ["n_views"], ["item"]), "n_views", "item")


@query("""SELECT user_id, event_id, event_type FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) WHERE before IS DISTINCT FROM event_type""")
def search_suppress(spark, sf_dir):
    return E.suppress_repeats(events(spark, sf_dir), "user_id", "event_id", "event_type").select("user_id", "event_id", "event_type")


@query("""WITH RECURSIVE v AS (
  SELECT user_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS t, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts)) AS n FROM events WHERE event_type = 'view'),
fold AS (
  SELECT user_id, n, t AS anchor, CAST(1 AS BIGINT) AS kept FROM v WHERE n = 1
  UNION ALL
  SELECT v.user_id, v.n, CASE WHEN v.t - f.anchor >= 1800 THEN v.t ELSE f.anchor END, f.kept + CASE WHEN v.t - f.anchor >= 1800 THEN 1 ELSE 0 END
  FROM fold f JOIN v ON v.user_id = f.user_id AND v.n = f.n + 1)
SELECT user_id, max(n) AS n_views, max(kept) AS n_counted FROM fold GROUP BY 1""")
def spaced_views(spark, sf_dir):
    views = events(spark, sf_dir).where("event_type = 'view'")
    return E.spaced_views(views, ["user_id"], "ts", 1800)


@query(f"""SELECT user_id, item FROM (SELECT user_id, {ITEM_SQL} AS item, max_by(CASE WHEN event_type = 'purchase' THEN 'add' ELSE 'remove' END, event_id) AS last
  FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1, 2) WHERE last = 'add'""")
def bookmarks_on(spark, sf_dir):
    log = events(spark, sf_dir).where(F.col("event_type").isin("purchase", "error"))
    log = log.withColumn("action", F.when(F.col("event_type") == "purchase", "add").otherwise("remove"))
    return E.toggled(log, ["user_id", "item"], "event_id", "action")


@query(f"SELECT {ITEM_SQL} AS item, count(*) AS n_views FROM events WHERE event_type = 'view' AND {ITEM_SQL} IS NOT NULL GROUP BY 1")
def view_counters(spark, sf_dir):
    return E.counters(events(spark, sf_dir).where("event_type = 'view'"), "item")
