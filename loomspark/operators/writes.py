"""Changes of stored tables as new versions: upserts, inserts that skip, replacements, merges of duplicates, states.

Nothing is updated in place. An operator returns the new table (or the rows to append); `overwrite_days` writes a mart by
its date partitions, so that a rerun replaces exactly what it computed.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(stored: DataFrame, fresh: DataFrame, keys: list[str], ordinal: str | None = None) -> DataFrame:
    """The stored rows whose keys are not fresh, and the fresh rows; with `ordinal`, of several fresh rows of a key the last.
    To rewrite only the partitions that change, see operators.guarded."""
    if ordinal is not None:
        fresh = fresh.groupBy(*keys).agg(F.max_by(F.struct(*fresh.columns), ordinal).alias("_row")).select("_row.*")
    return stored.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def insert_new(stored: DataFrame, fresh: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The rows to append: fresh ones whose keys are not stored, the first of each."""
    from .notices import first_wins

    return first_wins(fresh.join(stored.select(*keys), keys, "left_anti"), keys, ordinal)


def replace_groups(stored: DataFrame, fresh: DataFrame, group: list[str]) -> DataFrame:
    """Stored rows of groups that are computed anew go, with all that they held; the fresh rows take their place."""
    return stored.join(fresh.select(*group).distinct(), group, "left_anti").unionByName(fresh)


def overwrite_days(mart: DataFrame, path: str, day: str) -> None:
    """Write a mart partitioned by day; only the days in it are replaced."""
    mart.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def fill_from(rows: DataFrame, values: DataFrame, keys: list[str], column: str, value: str) -> DataFrame:
    """The column from a list of values where it has one that is not blank; else as it was."""
    new = values.select(*keys, F.nullif(F.trim(value), F.lit("")).alias("_new"))
    return rows.join(new, keys, "left").withColumn(column, F.coalesce("_new", column)).drop("_new").select(*rows.columns)


def resync(rows: DataFrame, source: DataFrame, key: str, source_key: str, column: str, value: str) -> DataFrame:
    """The column from its source, with `is_changed` where the two were distinct (null against a value counts)."""
    own = source.select(F.col(source_key).alias("_key"), F.col(value).alias("_new"))
    joined = rows.join(own, rows[key] == own["_key"], "left")
    changed = F.col("_key").isNotNull() & ~F.col(column).eqNullSafe(F.col("_new"))
    return joined.withColumn("is_changed", changed).withColumn(column, F.when(F.col("is_changed"), F.col("_new")).otherwise(F.col(column))).drop("_key", "_new")


def first_resolved(rows: DataFrame, lookups: list[tuple[DataFrame, str, str, str]], name: str) -> DataFrame:
    """Column `name` from the first of several lookups (table, row key, table key, value) that has one: equi joins, never an OR."""
    found = []
    for i, (table, key, own, value) in enumerate(lookups):
        side = table.select(F.col(own).alias(f"_k{i}"), F.col(value).alias(f"_v{i}"))
        rows = rows.join(side, rows[key] == side[f"_k{i}"], "left")
        found.append(F.col(f"_v{i}"))
    drop = [f"_{c}{i}" for i in range(len(lookups)) for c in "kv"]
    return rows.withColumn(name, F.coalesce(*found)).drop(*drop)


def survivors(rows: DataFrame, same: list[str], key: str) -> DataFrame:
    """(key, survivor): duplicate rows and the one with the smallest key that stays for them."""
    least = rows.groupBy(*same).agg(F.min(key).alias("survivor"))
    return rows.join(least, same).where(F.col(key) != F.col("survivor")).select(key, "survivor")


def repoint(rows: DataFrame, column: str, merged: DataFrame, key: str) -> DataFrame:
    """A reference column moved to the survivors."""
    own = merged.select(F.col(key).alias("_old"), F.col("survivor").alias("_new"))
    return rows.join(own, rows[column] == own["_old"], "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new").select(*rows.columns)


#: Moves of a reviewed notice: action -> (from, to).
MOVES = {"promote": ("new", "promoted"), "reject": ("new", "rejected"), "restore": ("rejected", "new")}


def review_states(log: DataFrame, item: str, order: str, action: str, part: Column | None = None) -> DataFrame:
    """(item, status): moves in order from "new"; a move that does not start at the state it finds is ignored.

    `part` cuts the order into stretches (it must not fall as the order grows). What a stretch does to each state is worked
    out by itself, so a long history is no single task's; stretches are then composed in their order.
    """
    states = list(dict.fromkeys(x for move in MOVES.values() for x in move))
    to = F.create_map(*(F.lit(x) for k, (a, b) in MOVES.items() for x in (f"{a}:{k}", b)))
    step = lambda state, m: F.coalesce(F.element_at(to, F.concat(state, F.lit(":"), m["do"])), state)
    stretch = F.lit(0) if part is None else part
    moves = log.groupBy(item, stretch.alias("_part")).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(action).alias("do")))).alias("_moves"))
    done = moves.select(item, "_part", F.create_map(*(x for s in states for x in (F.lit(s), F.aggregate("_moves", F.lit(s), step)))).alias("_does"))
    whole = done.groupBy(item).agg(F.array_sort(F.collect_list(F.struct("_part", F.array(*(F.element_at("_does", s) for s in states)).alias("to")))).alias("_parts"))
    at = F.create_map(*(F.lit(x) for k, s in enumerate(states) for x in (s, k)))
    return whole.select(item, F.aggregate("_parts", F.lit("new"), lambda state, p: F.get(p["to"], F.element_at(at, state))).alias("status"))


def run_log(spark, path: str, run_id: str, work) -> DataFrame:
    """Do the work and append one row on how it went; an error is recorded and raised again."""
    import time

    began, status, message = time.time(), "success", ""
    try:
        return work()
    except Exception as e:
        status, message = "failure", str(e)[:240]
        raise
    finally:
        row = [(run_id, status, message, int((time.time() - began) * 1000))]
        spark.createDataFrame(row, "run_id string, status string, message string, elapsed_ms long").write.mode("append").parquet(path)


def changed(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of `new` that differ from the stored row of their key in one of the columns."""
    before = old.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns))
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    return new.join(before, keys).where(differs).select(*new.columns)


def touched(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], stamp: str, now: Column) -> DataFrame:
    """The stored rows with the new values of `columns`, and `stamp` set to now where one of them changed; rows that are not
    written stay as they are."""
    fresh = new.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_written"))
    joined = old.join(fresh, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)], "left")
    written = F.coalesce("_written", F.lit(False))
    differs = written & reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in columns])
    values = {c: F.when(written, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns} | {stamp: F.when(differs, now).otherwise(F.col(stamp)).alias(stamp)}
    return joined.select(*(values.get(c, F.col(c)) for c in old.columns))


def ingested(calls: DataFrame, fields: list[str], payload: str, user: Column, now: Column) -> DataFrame:
    """Calls of the event endpoint as rows of the log: who called and when, missing fields as null, a missing payload empty."""
    have = set(calls.columns)
    given = [(F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in fields]
    extra = F.coalesce(F.col(payload), F.lit("{}")) if payload in have else F.lit("{}")
    return calls.select(*given, user.alias("user_id"), now.alias("created_at"), extra.alias(payload))
