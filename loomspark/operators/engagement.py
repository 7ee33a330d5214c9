"""Marts of the event log: daily and per-item KPIs, search terms, cohort retention, and their roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import written
from .ranks import placed_within, same


def kinds_of(kind: str, kinds: dict[str, str]) -> list[Column]:
    return [F.count_if(F.col(kind) == v).alias(k) for k, v in kinds.items()]


def daily_kpi(events: DataFrame, day: str, user: str, kind: str, kinds: dict[str, str]) -> DataFrame:
    """One row per day: distinct users, events, and a filtered count for each of `kinds` (column name -> event kind)."""
    return events.groupBy(day).agg(F.countDistinct(user).alias("active_users"), F.count(F.lit(1)).alias("n_events"), *kinds_of(kind, kinds))


def day_kpi(events: DataFrame, day: str, on: str, user: str, kind: str, kinds: dict[str, str]) -> DataFrame:
    """One row for the day, also where it has no event."""
    own = events.where(F.col(day) == F.lit(on).cast("date"))
    return own.agg(F.lit(on).cast("date").alias(day), F.countDistinct(user).alias("active_users"), F.count(F.lit(1)).alias("n_events"), *kinds_of(kind, kinds))


def item_kpi(events: DataFrame, day: str, item: str, user: str, kind: str, kinds: dict[str, str]) -> DataFrame:
    """One row per day and item; events without an item don't count."""
    return events.where(F.col(item).isNotNull()).groupBy(day, item).agg(F.countDistinct(user).alias("active_users"), *kinds_of(kind, kinds))


def term_counts(events: DataFrame, day: str, term: str) -> DataFrame:
    """Searches per day and term as it was typed; blank terms don't count."""
    return events.where(F.trim(term) != "").groupBy(day, term).agg(F.count(F.lit(1)).alias("n_searches"))


def retention(events: DataFrame, day: str, user: str, until: str | None = None, horizons: tuple[int, ...] = (1, 3, 7)) -> DataFrame:
    """One row per cohort (first active day) up to `until`: size, users back after k days, and their rates in per cent.

    A user's first day is the minimum over their distinct days, so users are shuffled once. Horizons still in the future
    count 0.
    """
    seen = events.where(F.col(user).isNotNull())
    if until:
        seen = seen.where(F.col(day) <= F.lit(until).cast("date"))
    days = seen.groupBy(user).agg(F.collect_set(day).alias("days"))
    first = days.select(F.array_min("days").alias("cohort_date"), "days")
    back = [F.count_if(F.array_contains("days", F.date_add("cohort_date", k))).alias(f"d{k}_users") for k in horizons]
    sized = first.groupBy("cohort_date").agg(F.count(F.lit(1)).alias("cohort_size"), *back)
    rate = lambda k: F.round(F.lit(100.0) * F.col(f"d{k}_users") / F.nullif("cohort_size", F.lit(0)), 2)
    return sized.select("*", *(rate(k).alias(f"d{k}_rate") for k in horizons))


def latest_mature(cohorts: DataFrame, as_of: str, horizons: tuple[int, ...] = (1, 3, 7)) -> DataFrame:
    """One row: for each horizon the rate of the last cohort that is old enough."""
    old = lambda k: F.col("cohort_date") <= F.date_sub(F.lit(as_of).cast("date"), k)
    last = lambda c, k: F.max_by(F.when(old(k), F.col(c)), F.when(old(k), F.col("cohort_date")))
    return cohorts.agg(*(x for k in horizons for x in (last("cohort_date", k).alias(f"d{k}_cohort"), last(f"d{k}_rate", k).alias(f"d{k}_rate"))))


def sums(marts: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Totals of mart columns. Daily users add up to visits, not to distinct users."""
    totals = [F.sum(c).alias(c) for c in columns]
    return marts.groupBy(*by).agg(*totals) if by else marts.agg(*totals)


def top(df: DataFrame, value: str, key: str, n: int = 10) -> DataFrame:
    """The n largest, the smaller key first where they tie."""
    return df.orderBy(F.desc(value), F.asc(key)).limit(n)


def suppress_repeats(searches: DataFrame, session: str, order: str, query: str) -> DataFrame:
    """Searches that differ from the session's last one."""
    before = F.lag(query).over(Window.partitionBy(session).orderBy(order))
    return searches.withColumn("_before", before).where(~F.col("_before").eqNullSafe(F.col(query))).drop("_before")


#: Views of a key from which on its history is not folded in one task.
LONG = 100_000


def spaced_views(views: DataFrame, keys: list[str], ts: str, seconds: int = 300) -> DataFrame:
    """Views that count: each at least `seconds` after the last one that counted. (keys, n_views, n_counted)

    The anchor is the last counted view, which no window frame knows. Keys with few views are folded; of keys with many the
    chain of counted views is found by doubled pointers, in many tasks.
    """
    timed = views.select(*keys, F.unix_seconds(F.col(ts).cast("timestamp")).alias("_at"))
    many = written(timed.groupBy(*keys).agg(F.count("_at").alias("_n")).where(F.col("_n") > LONG).select(*keys))
    if many.isEmpty():
        return folded(timed, keys, seconds)
    other = many.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)))
    on = same(keys, other.columns)
    return folded(timed.join(other, on, "left_anti"), keys, seconds).unionByName(chained(timed.join(other, on, "left_semi"), keys, seconds))


def folded(timed: DataFrame, keys: list[str], seconds: int) -> DataFrame:
    """Counted views by a fold over sorted times, on the JVM. A view that comes so long after the one before it counts whatever
    came earlier, so times are folded run by run: what is gathered in one row is a run without such a gap."""
    order = Window.partitionBy(*keys).orderBy("_at")
    fresh = F.coalesce((F.col("_at") - F.lag("_at").over(order) >= seconds).cast("int"), F.lit(0))
    runs = timed.withColumn("_fresh", fresh).withColumn("_run", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    times = runs.groupBy(*keys, "_run").agg(F.array_sort(F.collect_list("_at")).alias("_at"))
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("n"))
    counts = lambda a, t: a["last"].isNull() | (t - a["last"] >= seconds)
    step = lambda a, t: F.when(counts(a, t), F.struct(t.alias("last"), (a["n"] + 1).alias("n"))).otherwise(a)
    each = times.select(*keys, F.size("_at").cast("bigint").alias("n"), F.aggregate("_at", start, step, lambda a: a["n"]).alias("c"))
    return each.groupBy(*keys).agg(F.sum("n").alias("n_views"), F.sum("c").alias("n_counted"))


def chained(timed: DataFrame, keys: list[str], seconds: int) -> DataFrame:
    """Counted views by pointers: a view's next counted one is the first that comes `seconds` later or more.

    Where that is follows from places: sorted together, a moment `seconds` after a view stands behind as many views as come
    before it. The first view of a key counts; with pointers over 1, 2, 4, ... counted views the known part of the chain
    doubles in each round, so a chain of n takes log n rounds.
    """
    if seconds <= 0:
        return timed.where("_at IS NOT NULL").groupBy(*keys).agg(F.count("_at").alias("n_views"), F.count("_at").alias("n_counted"))
    each = timed.where("_at IS NOT NULL").groupBy(*keys, "_at").agg(F.count(F.lit(1)).alias("_n"))
    own = placed_within(each, keys, F.asc("_at"), name="_place")
    both = own.select(*keys, "_at", "_place", F.lit(1).alias("_kind")).unionByName(own.select(*keys, (F.col("_at") + seconds).alias("_at"), "_place", F.lit(0).alias("_kind")))
    found = placed_within(both, keys, F.asc("_at"), F.asc("_kind"), name="_rank").where("_kind = 0")
    names = [f"_key{i}" for i in range(len(keys))]
    renamed = lambda df, *more: df.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), *more)
    jump = found.select(*keys, "_place", (F.col("_rank") - F.col("_place") + 1).alias("_next"))
    last = renamed(own.groupBy(*keys).agg(F.max("_place").alias("_last")), "_last")
    jump = written(jump.join(last, same(keys, names)).where("_next <= _last").select(*keys, "_place", "_next"))
    chain = written(last.select(*(F.col(n).alias(k) for k, n in zip(keys, names, strict=True)), F.lit(1).cast("bigint").alias("_place")))
    while True:
        to = renamed(jump, F.col("_place").alias("_from"), F.col("_next").alias("_to"))
        more = written(chain.join(to, same(keys, names) & (F.col("_place") == F.col("_from"))).select(*keys, F.col("_to").alias("_place")))
        if more.isEmpty():
            break
        chain = written(chain.unionByName(more))
        jump = written(jump.join(to, same(keys, names) & (F.col("_next") == F.col("_from"))).select(*keys, "_place", F.col("_to").alias("_next")))
    counted = renamed(chain.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_counted")), "n_counted")
    total = own.groupBy(*keys).agg(F.sum("_n").alias("n_views"))
    return total.join(counted, same(keys, names)).select(*keys, "n_views", "n_counted")


def toggled(log: DataFrame, keys: list[str], order: str, action: str, on: str = "add") -> DataFrame:
    """What is switched on: the last entry of each key decides."""
    last = log.groupBy(*keys).agg(F.max_by(action, order).alias("_last"))
    return last.where(F.col("_last") == on).drop("_last")


def counters(log: DataFrame, item: str) -> DataFrame:
    """A counter as the number of its events; nothing is incremented in place."""
    return log.where(F.col(item).isNotNull()).groupBy(item).agg(F.count(F.lit(1)).alias("n_views"))


def calendar(items: DataFrame, end: str, key: str, as_of: str, urgent: int = 6) -> DataFrame:
    """One row per deadline: its items in key order, how far away it is, and whether it is urgent (0 to `urgent` days)."""
    left = F.datediff(F.col(end), F.lit(as_of).cast("date"))
    days = items.where(F.year(end) < 2099).groupBy(end).agg(F.array_sort(F.collect_list(key)).alias("items"))
    return days.withColumn("days_left", left).withColumn("is_urgent", F.col("days_left").between(0, urgent)).withColumn("n_items", F.size("items").cast("bigint"))
