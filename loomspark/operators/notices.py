"""The notice pipeline: cleaning, first-wins, merging, keys, duplicates, lifecycle, plans of writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions.text import clean_text
from ..sources.files import written
from .ranks import placed


def first_wins(rows: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The first row of each key in the order of `ordinal`. A minimum over whole rows combines before the shuffle."""
    own = F.struct(ordinal, *(c for c in rows.columns if c != ordinal))
    return rows.groupBy(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keys))).agg(F.min_by(own, ordinal).alias("_row")).select("_row.*").select(*rows.columns)


def classify(rows: DataFrame, source: str, title: str, url: str, ordinal: str) -> DataFrame:
    """Rows with `reason`: null for notices, else why a row is none; later rows of one source and address are duplicates."""
    own = rows.withColumn("reason", D.reject_reason(F.col(title), F.col(url)))
    order = Window.partitionBy("_source", "_url", F.col("reason").isNull()).orderBy(ordinal)
    keyed = own.withColumns({"_source": clean_text(F.col(source)), "_url": clean_text(F.col(url))}).withColumn("_nth", F.row_number().over(order))
    reason = F.when(F.col("reason").isNull() & (F.col("_nth") > 1), "duplicate_notice").otherwise(F.col("reason"))
    return keyed.withColumn("reason", reason).drop("_source", "_url", "_nth")


def audit(rows: DataFrame, title: str, url: str) -> DataFrame:
    """Rows with flags that may hold together: menu-like, odd or very short titles, addresses without detail, insecure ones."""
    t, u = clean_text(F.col(title)), clean_text(F.col(url))
    return rows.withColumns(
        {
            "menu_like": t.rlike(r"(?i)장학(?:금)?\s*(?:안내|지원|제도|FAQ)?$|장학게시판$|장학안내$|Scholarship\s*/?\s*Job"),
            "very_short": F.length(F.regexp_replace(t, r"\s+", "")) <= 6,
            "odd_english": t.rlike("(?i)ScholarshipScholarship|Scholarship / JobScholarship / Job"),
            "no_detail": ~u.rlike(r"(?i)mode=view|articleNo=|artclView\.do|uid=\d+|mod=document"),
            "insecure": u.rlike("(?i)^http://"),
        }
    )


def duplicate_groups(rows: DataFrame, key: Column, members: dict[str, str], most: int | None = None) -> DataFrame:
    """Keys that several rows share: how many, and the distinct values of each member column, sorted. Null keys don't count."""
    lists = [F.array_sort(F.collect_set(c)).alias(n) for n, c in members.items()]
    found = rows.withColumn("_key", key).where(F.col("_key").isNotNull() & (F.col("_key") != "")).groupBy(F.col("_key").alias("key")).agg(F.count(F.lit(1)).alias("n_rows"), *lists).where("n_rows > 1")
    return found if most is None else found.withColumns({n: F.slice(n, 1, most) for n in members})


def across_sources(groups: DataFrame, sources: str) -> DataFrame:
    return groups.where(F.size(sources) > 1)


def best_of(rows: DataFrame, key: list[str], priority: str, ordinal: str, keep: list[str]) -> DataFrame:
    """Of each key with several rows the columns of the one with the highest priority, the earliest where they tie."""
    first = F.struct(F.col(priority).alias("a"), (-F.col(ordinal)).alias("b"))
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), F.max_by(F.struct(*keep), first).alias("_best")).where("n_rows > 1").select(*key, "n_rows", "_best.*")


def numbered_ids(rows: DataFrame, prefix: str, ordinal: str, name: str = "source_id") -> DataFrame:
    """prefix_001, prefix_002, ... in order; the number grows past three digits where it must."""
    nth = placed(rows, F.asc(ordinal), name="_nth_of_all")
    return nth.withColumn(name, F.concat(F.lit(f"{prefix}_"), F.format_string("%03d", "_nth_of_all"))).drop("_nth_of_all")


def first_n(rows: DataFrame, by: list[str], ordinal: str, n: int) -> DataFrame:
    """The first n rows of each group."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(ordinal))
    return rows.withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth")


def first_total(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows over all sources, in source order: a limit that carries over."""
    return rows.orderBy(*order).limit(n)


def unseen(rows: DataFrame, key: str, state: DataFrame, state_key: str) -> DataFrame:
    """Rows whose key the state has not seen."""
    return rows.join(state.select(F.col(state_key).alias(key)), key, "left_anti")


def tagged_union(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """Rows of several tables by name, missing columns null, each with the name of its table."""
    tagged = [df.withColumn(tag, F.lit(k)) for k, df in parts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def tiered(parts: list[DataFrame], key: str, ordinal: str) -> DataFrame:
    """Rows of tables in order of preference, the first of each key."""
    ranked = tagged_union({f"{i:04d}": df for i, df in enumerate(parts)}, "_tier").withColumn("_order", F.struct("_tier", ordinal))
    return first_wins(ranked, [key], "_order").drop("_order", "_tier")


def visibility(previous: DataFrame, current: DataFrame, health: DataFrame, key: str, source: str) -> DataFrame:
    """Rows of the last run with `classification` and `keep` (they must not be taken for deleted)."""
    seen = current.select(key).distinct().withColumn("_seen", F.lit(True))
    state = health.select(source, "run_quality", "pagination_incomplete", "blocked_or_captcha", "safe_for_missing_detection")
    joined = previous.join(seen, key, "left").join(state, source, "left")
    found = D.visibility(F.coalesce("_seen", F.lit(False)), F.col("run_quality"), F.col("pagination_incomplete"), F.col("blocked_or_captcha"), F.col("safe_for_missing_detection"))
    out = joined.withColumn("classification", found).withColumn("keep", ~F.col("classification").isin("still_visible", "potentially_missing"))
    return out.drop("_seen", "run_quality", "pagination_incomplete", "blocked_or_captcha", "safe_for_missing_detection")


def write_operations(changes: Column, local: Column, quality: Column, safe: Column, targets: Column, assets: Column, noted: Column) -> Column:
    """array<struct<operation,blocked,reason,review>>: what applying one notice would write, in order."""
    unknown = F.array_contains(changes, "unknown_without_db_check")
    unsafe = ~F.coalesce(safe, F.lit(True))
    missing = local == "blocked_by_missing_required_field"
    weak = (F.size(quality) > 0) | (local == "needs_quality_review")
    degraded = F.array_contains(changes, "body_quality_degraded")
    why = D.first_of([(missing, "missing_required_field"), (unsafe, "unsafe_source_health"), (unknown, "unknown_without_db_check")])
    none = F.lit(None).cast("string")

    def op(name: str, reason: Column = none, review: Column | bool = True, stuck: Column | None = None) -> Column:
        blocked = reason.isNotNull() if stuck is None else stuck
        return F.struct(F.lit(name).alias("operation"), blocked.alias("blocked"), reason.alias("reason"), (F.lit(review) if isinstance(review, bool) else review).alias("review"))

    asked = F.when(unknown, F.lit("unknown_without_db_check"))
    blocked = why.isNotNull()
    notice = F.coalesce(why, F.when(weak, F.lit("needs_quality_review")))
    body = D.first_of([(unsafe, "unsafe_source_health"), (degraded, "body_quality_degraded")])
    main = (
        F.when(local == "unchanged_candidate", F.array(op("no_op_unchanged", review=False)))
        .when(local == "url_alias_candidate", F.array(op("add_url_alias"), op("insert_occurrence")))
        .when(local == "changed_candidate", F.array(op("update_notice_metadata", F.when(unsafe, F.lit("unsafe_source_health"))), op("update_notice_body", body)))
        .otherwise(F.array(op("insert_notice", notice)))
    )
    times = lambda n, x: F.array_repeat(x, F.coalesce(n, F.lit(0)).cast("int"))
    empty = F.slice(F.array(op("x")), 1, 0)
    when = lambda c, x: F.when(c, F.array(x)).otherwise(empty)
    return F.concat(
        F.array(op("insert_run", asked), op("insert_source_result", asked)),
        main,
        when(weak, op("skip_update_due_to_low_quality", F.lit("needs_quality_review"))),
        when(unsafe, op("skip_update_due_to_source_health", F.lit("unsafe_source_health"))),
        F.array(op("insert_occurrence", why, blocked)),
        times(targets, op("insert_notice_target", why, blocked)),
        times(assets, op("insert_asset", why, blocked)),
        when(F.coalesce(noted, F.lit(False)), op("insert_error", review=False)),
        F.array(op("insert_keyword_match", why, blocked)),
    )


def plan_summary(items: DataFrame, operations: str) -> DataFrame:
    """One row per operation: how often, how often blocked, how often for review."""
    each = items.select(F.explode(operations).alias("o")).select("o.*")
    return each.groupBy("operation").agg(F.count(F.lit(1)).alias("n_operations"), F.count_if("blocked").alias("n_blocked"), F.count_if("review").alias("n_review"))


def missing_parents(selected: DataFrame, item: list[str], operation: str, parents: dict[str, list[str]]) -> DataFrame:
    """Operations whose item lacks an operation that they depend on, with the names of what is missing."""
    table = F.create_map(*(x for k, v in parents.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    planned = selected.groupBy(*item).agg(F.collect_set(operation).alias("_have"))  # names are few, however many rows
    each = planned.select(*item, "_have", F.explode("_have").alias(operation))
    lost = F.array_except(F.coalesce(F.element_at(table, F.col(operation)), F.array().cast("array<string>")), F.col("_have"))
    return each.select(*item, operation, F.array_sort(lost).alias("missing_parents")).where(F.size("missing_parents") > 0)


def selected(operations: DataFrame, item: str, order: str, reasons: str, most: int) -> DataFrame:
    """Operations with their reasons of exclusion; items beyond the first `most` that have none are over the limit.

    Places beyond the limit are all alike, so nothing is ranked: the `most` lowest of the items' first places are kept while
    they are read, and the last of these is the bound that tells the items apart.
    """
    clear = F.size(reasons) == 0
    firsts = operations.where(clear).groupBy(item).agg(F.min(order).alias("_first"))
    lowest = firsts.where(F.col("_first").isNotNull()).select("_first").distinct().orderBy("_first").limit(most)
    last = lowest.agg(F.max("_first").alias("_last"))  # one row
    # an item without any place is not beyond the limit
    inside = firsts.crossJoin(F.broadcast(last)).where(F.col("_first").isNull() | (F.col("_first") <= F.col("_last")))
    inside = written(inside.select(F.col(item).alias("_inside")))
    joined = operations.join(inside, F.col(item) == F.col("_inside"), "left")
    over = clear & F.col(item).isNotNull() & F.col("_inside").isNull()
    return joined.withColumn(reasons, F.when(over, F.array(F.lit("max_items_limit_reached"))).otherwise(F.col(reasons))).drop("_inside")


def resolved_names(rows: DataFrame, key: str, variants: str, scope: str, units: DataFrame, unit: str, name: str, stem: str, unit_scope: str, stem_of) -> DataFrame:
    """(key, unit): the one unit that a row's first resolving name variant means: own scope before any, names before stems.

    A variant that means several units means none, and the next one is tried.
    """
    tried = rows.select(key, F.col(scope).alias("_scope"), F.posexplode(variants).alias("_pos", "_name")).withColumn("_stem", stem_of(F.col("_name")))
    known = units.select(F.col(unit).alias("_unit"), F.col(name).alias("_uname"), F.col(stem).alias("_ustem"), F.col(unit_scope).alias("_uscope"))
    exact = tried.join(known, F.col("_name") == F.col("_uname")).withColumn("_how", F.lit(0))
    loose = tried.join(known, F.col("_stem") == F.col("_ustem")).withColumn("_how", F.lit(1))
    hits = exact.unionByName(loose)
    near = hits.where(F.col("_scope") == F.col("_uscope")).withColumn("_far", F.lit(0)).unionByName(hits.withColumn("_far", F.lit(1)))
    one = near.groupBy(key, "_far", "_pos", "_how").agg(F.countDistinct("_unit").alias("_n"), F.min("_unit").alias("_unit")).where("_n = 1")
    return one.groupBy(key).agg(F.min_by("_unit", F.struct("_far", "_pos", "_how")).alias(unit))


def fallback_source(sources: DataFrame, key: str, group: str, college: str, ordinal: str, broken: str, wide: str) -> DataFrame:
    """(key, fallback): for broken sources the group's wide source, else the first sound one of the college, else of the group."""
    sound = sources.where(~F.col(broken)).select(F.col(key).alias("_key"), F.col(group).alias("_g"), F.col(college).alias("_c"), F.col(ordinal).alias("_o"), F.col(wide).alias("_w"))
    first = lambda df, *by: df.groupBy(*by).agg(F.min_by("_key", "_o").alias("_key"))
    bad = sources.where(broken).select(key, group, college)
    # each scope's first sound source is one row, so the broken ones meet three rows and not all of their group
    found = bad.join(first(sound.where("_w"), "_g").withColumnRenamed("_key", "_wide"), F.col(group) == F.col("_g"), "left").drop("_g")
    found = found.join(first(sound, "_g", "_c").withColumnRenamed("_key", "_near"), (F.col(group) == F.col("_g")) & (F.col(college) == F.col("_c")), "left").drop("_g", "_c")
    found = found.join(first(sound, "_g").withColumnRenamed("_key", "_any"), F.col(group) == F.col("_g"), "left")
    return found.select(key, F.coalesce("_wide", "_near", "_any").alias("fallback")).where(F.col("fallback").isNotNull())


def preferred_pick(rows: DataFrame, key: str, preferred: str, ordinal: str, keep: list[str]) -> DataFrame:
    """One candidate per key: the sole one, else the first preferred one, else the first."""
    order = F.struct(F.when(F.col(preferred), 0).otherwise(1).alias("a"), F.col(ordinal).alias("b"))
    return rows.groupBy(key).agg(F.min_by(F.struct(*keep), order).alias("_p"), F.count(F.lit(1)).alias("n_candidates")).select(key, "n_candidates", "_p.*")


def operation_rows(items: DataFrame, operations: str, keys: list[str], ordinal: str) -> DataFrame:
    """Planned operations as rows, each key once: the first item that plans it keeps it."""
    each = items.select(*items.columns, F.posexplode(operations).alias("_pos", "_o")).select(*[c for c in items.columns if c != operations], "_pos", "_o.*")
    return first_wins(each.withColumn("_at", F.struct(ordinal, "_pos")), keys, "_at").drop("_at", "_pos")


def renamed(units: DataFrame, name: str, scope: str, names: DataFrame, old: str, new: str) -> DataFrame:
    """Units with names brought to their new form, where a list of (scope, old, new) has one; `is_renamed` tells which."""
    table = names.select(F.col(scope).alias("_scope"), F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = units.join(table, (units[scope] == table["_scope"]) & (units[name] == table["_old"]), "left")
    return joined.withColumn("is_renamed", F.col("_new").isNotNull()).withColumn(name, F.coalesce("_new", name)).drop("_scope", "_old", "_new")
