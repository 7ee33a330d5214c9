"""Quality metrics, alerts, source health, roll-ups and funnels over crawl results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double; 0 where b is 0 or missing."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def rates() -> dict[str, Column]:
    c = F.col
    candidates = c("cleaned") + c("rejected")
    return {
        "success_rate": ratio(c("sources") - c("errors"), c("sources")),
        "precision": ratio(c("cleaned"), candidates),
        "false_positive_rate": ratio(c("rejected"), candidates),
        "coverage": F.when(c("matched") > 0, ratio(c("matched"), c("sources"))).otherwise(0.0),
    }


def quality_metrics(groups: DataFrame) -> DataFrame:
    """Groups (sources, errors, cleaned, rejected, matched) with their rates; nothing divides by zero."""
    return groups.withColumns(rates())


def quality_totals(groups: DataFrame) -> DataFrame:
    """One row: sums, and rates of the sums (never means of rates)."""
    names = ["sources", "errors", "cleaned", "rejected", "matched"]
    total = groups.agg(F.count(F.lit(1)).alias("n_groups"), *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
    return total.withColumns({k: v for k, v in rates().items() if k != "coverage"})


def median_positive(x: Column) -> Column:
    """Median of the positive values, the mean of two middles; 0 without any."""
    return F.coalesce(F.median(F.when(x > 0, x)), F.lit(0.0))


def drop_alerts(days: DataFrame, day: str, value: str, drop: float = K.DAILY_DROP_RATIO, back: int = K.QUALITY_DAYS) -> DataFrame:
    """Days with the median of up to `back` days before them, and is_drop: the value is under `drop` of that median."""
    # one row a day: the frame is a handful of rows, and the sequence as long as the history in days
    window = Window.orderBy(day).rowsBetween(-back, -1)
    out = days.withColumn("_seen", F.array_sort(F.filter(F.collect_list(value).over(window), lambda x: x > 0)))
    n = F.size("_seen")
    middle = (F.get("_seen", F.floor((n - 1) / 2).cast("int")) + F.get("_seen", F.floor(n / 2).cast("int"))) / 2.0
    out = out.withColumn("recent_median", F.when(n > 0, middle).otherwise(0.0)).drop("_seen")
    return out.withColumn("is_drop", (F.col("recent_median") > 0) & (F.col(value) / F.col("recent_median") < drop))


def success_alerts(days: DataFrame, group: str, day: str, rate: str, drop: float = K.SUCCESS_DROP) -> DataFrame:
    """Rows whose rate is lower by `drop` or more than the group's last one."""
    before = F.lag(rate).over(Window.partitionBy(group).orderBy(day))
    return days.withColumn("previous", before).where(F.col(rate) - F.col("previous") <= -drop)


def error_streaks(days: DataFrame, source: str, day: str, error: str, least: int = K.ERROR_STREAK) -> DataFrame:
    """Sources whose last `least` days or more all failed: how many, and the last error."""
    latest = Window.partitionBy(source).orderBy(F.desc(day)).rowsBetween(Window.unboundedPreceding, 0)
    bad = F.coalesce(F.trim(F.col(error).cast("string")), F.lit("")) != ""
    run = days.withColumn("_ok", F.sum(F.when(bad, 0).otherwise(1)).over(latest)).where("_ok = 0")
    out = run.groupBy(source).agg(F.count(F.lit(1)).alias("streak"), F.max_by(error, day).alias("last_error"))
    return out.where(F.col("streak") >= least)


def last_days(rows: DataFrame, day: str, n: int) -> DataFrame:
    """Rows of the last n days that there are."""
    keep = rows.select(day).distinct().orderBy(F.desc(day)).limit(n)
    return rows.join(F.broadcast(keep), day, "left_semi")


def frequency(rows: DataFrame, key: Column, name: str = "key", empty: str | None = None) -> DataFrame:
    """Counts per key; empty keys don't count, or count as `empty`."""
    k = F.nullif(key, F.lit(""))
    k = F.coalesce(k, F.lit(empty)) if empty else k
    return rows.select(k.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"))


def pivot_counts(rows: DataFrame, by: str, bucket: str, buckets: list[str]) -> DataFrame:
    """One row per group with a count for every bucket, seen or not."""
    return rows.groupBy(by).agg(*(F.count_if(F.col(bucket) == b).alias(b) for b in buckets))


def roll_up(rows: DataFrame, by: str, decision: str, decisions: list[str], lists: dict[str, str]) -> DataFrame:
    """One row per group: rows, a count for each decision, and distinct codes, sorted and joined by bars ("none" without any)."""
    joined = [F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit("")))), "|"), F.lit("")), F.lit("none")).alias(n) for n, c in lists.items()]
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.col(decision) == d).alias(d) for d in decisions), *joined)


def per_value(rows: DataFrame, values: str, decision: str, decisions: list[str], name: str = "profile") -> DataFrame:
    """As above by the values of an array: a row counts once under each, and under "none" where it has none."""
    own = F.when(F.coalesce(F.size(values), F.lit(0)) == 0, F.array(F.lit("none"))).otherwise(F.array_distinct(values))
    each = rows.select(F.explode(own).alias(name), decision)
    return each.groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.col(decision) == d).alias(d) for d in decisions))


def feedback(rows: DataFrame, group: str, status: str) -> DataFrame:
    """Review results per group with the share that was promoted."""
    kinds = {"n_new": "new", "n_promoted": "promoted", "n_rejected": "rejected"}
    own = rows.groupBy(F.coalesce(F.nullif(F.trim(group), F.lit("")), F.lit("unknown")).alias("source_group"))
    out = own.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.col(status) == v).alias(k) for k, v in kinds.items()))
    return out.withColumn("promote_rate", ratio(F.col("n_promoted"), F.col("n_rows")))


def funnel(rows: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """One row: how many rows pass each stage and all before it."""
    passed, out = F.lit(True), []
    for name, test in stages.items():
        passed = passed & F.coalesce(test, F.lit(False))
        out.append(F.count_if(passed).alias(name))
    return rows.agg(*out)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its rows."""
    parts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """One row: how many child rows have a key that the parent lacks."""
    lost = child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")
    return lost.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("n_rows"))


def violations(rows: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(key, check_name): every check that a row fails. A check that is null fails too."""
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks.items())))
    return rows.select(key, F.explode(failed).alias("check_name"))


def empty_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how often each column is blank."""
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    return rows.agg(*(F.count_if(blank(c)).alias(c) for c in columns))


def null_ratios(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns))


def group_names(rows: DataFrame, unit: str, departments: str, colleges: str, sources: str, level: str, ordinal: str) -> DataFrame:
    """One row per unit: a name (its one department, else its one college, else its first source "and n more") and a type."""
    order = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.trim(c) != "", F.struct(ordinal, F.trim(c).alias("v"))))), lambda x: x["v"]))
    own = rows.groupBy(unit).agg(order(departments).alias("_d"), order(colleges).alias("_c"), order(sources).alias("_s"), F.collect_set(F.lower(F.trim(level))).alias("_l"))
    one = lambda c: F.when(F.size(c) == 1, F.element_at(c, 1))
    many = F.when(F.size("_s") > 1, F.concat(F.element_at("_s", 1), F.lit(" 외 "), (F.size("_s") - 1).cast("string")))
    name = F.coalesce(one(F.col("_d")), one(F.col("_c")), one(F.col("_s")), many, F.concat(F.lit("csv-org-unit-"), F.col(unit).cast("string")))
    kind = F.coalesce(*(F.when(F.array_contains("_l", t), F.lit(t)) for t in ("university", "college", "division")), F.lit("department"))
    return own.select(unit, name.alias("name"), kind.alias("unit_type"))


def digest(rows: DataFrame, group: str, title: str, url: str, order: str) -> DataFrame:
    """One message per group: a line for each notice, in order."""
    line = F.concat(F.lit("• <"), F.col(url), F.lit("|"), F.col(title), F.lit(">"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, line.alias("line")))), lambda x: x["line"])
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), F.array_join(lines, "\n").alias("message"))


def stage_report(events: DataFrame, source: str, stage: str, status: str, elapsed: str, stages: list[str]) -> DataFrame:
    """One wide row per source: the last status of each stage, the total time, and the first stage that failed."""
    last = [F.max_by(F.when(F.col(stage) == s, F.col(status)), F.when(F.col(stage) == s, F.col("ordinal"))).alias(s) for s in stages]
    failed = F.min_by(stage, F.when(F.col(status) == "failed", F.col("ordinal")))
    return events.groupBy(source).agg(*last, F.sum(elapsed).alias("elapsed_ms"), failed.alias("first_failed"))


def percent(x: Column, digits: int = 1) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", x * 100), F.lit("%"))


def numbered_keys(rows: DataFrame, key: str) -> DataFrame:
    """Rows with `_place`, the rank of their key from 1. Keys are range-partitioned and counted per partition, so no task sees
    all of them."""
    from ..sources.files import written

    ranged = written(rows.select(key).distinct().repartitionByRange(F.col(key)).withColumn("_part", F.spark_partition_id()))
    before = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    base = before.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = ranged.withColumn("_nth", F.row_number().over(Window.partitionBy("_part").orderBy(key)))
    placed = own.join(base.select("_part", "_base"), "_part").select(key, (F.col("_base") + F.col("_nth")).alias("_place"))
    return rows.join(placed, key)


def tree_integrity(nodes: DataFrame, node: str, path: str, sources: dict[str, DataFrame], profiles: DataFrame, unit: str, older: list[str]) -> DataFrame:
    """One row: rows of the tables that the tree was made of, its nodes, paths that do not end at their node, and profiles
    that name an older unit but none of the tree."""
    total = row_counts(sources).agg(F.sum("n_rows").alias("legacy_total"))
    ends = F.try_element_at(F.col(path), F.lit(-1))
    tree = nodes.agg(F.count(F.lit(1)).alias("node_total"), F.count_if(~ends.eqNullSafe(F.col(node))).alias("broken_paths"))
    lost = profiles.agg(F.count_if(F.col(unit).isNull() & F.coalesce(*(F.col(c).cast("string") for c in older)).isNotNull()).alias("unmapped_profiles"))
    return total.join(tree).join(lost)
