"""Lists: who may be on them, in what order, with which counts, and one page of them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import offer_name
from .containment import marked
from .ranks import placed, placed_within, same


def searched(items: DataFrame, query: str, name: str, organisation: str) -> DataFrame:
    """Items whose name, display name or organisation holds the query, case aside; a blank query keeps all."""
    q = query.strip().lower()
    if not q:
        return items
    hit = lambda c: F.contains(F.lower(c), F.lit(q))
    return items.where(hit(F.col(name)) | hit(offer_name(F.col(name))) | hit(F.col(organisation)))


def admin_search(items: DataFrame, query: str, *columns: str) -> DataFrame:
    """Items one of whose columns holds the query literally: per cent signs and underscores are no wildcards."""
    q = F.lit(query.strip().lower())
    return items.where(reduce(or_, [F.contains(F.lower(F.col(c)), q) for c in columns]))


def without_names(items: DataFrame, text: Column, names: DataFrame, name: str, least: int = 3) -> DataFrame:
    """Items whose text holds none of the names of `least` characters or more, case aside."""
    wanted = names.select(F.lower(F.trim(name)).alias("_name")).where(F.char_length("_name") >= least)
    return marked(items, [F.lower(text)], wanted, "_name", False, "_held").where(~F.col("_held")).drop("_held")


def on_campus(items: DataFrame, restricted: str, texts: list[str], names: DataFrame, name: str) -> DataFrame:
    """is_campus: the item is restricted to institutions, or one of its texts holds an institution's name (wildcards live)."""
    wanted = names.select(F.lower(F.trim(name)).alias("_name")).where(F.col("_name") != "")
    rows = marked(items, [F.lower(c) for c in texts], wanted, "_name", True, "_held")
    return rows.withColumn("is_campus", F.coalesce(F.size(restricted) > 0, F.lit(False)) | F.col("_held")).drop("_held")


def with_counts(items: DataFrame, key: str, log: DataFrame, log_key: str, name: str = "scrap_count", few: bool = False) -> DataFrame:
    """Items with the number of their entries in the log, 0 where there is none.

    `few`: the items are a page, so their keys go to the log and only their entries are counted and shuffled.
    """
    own = log.select(F.col(log_key).alias("_key"))
    if few:
        own = own.join(items.select(F.col(key).alias("_key")), "_key", "left_semi")  # Spark knows a page's size by its limit
    counts = own.groupBy("_key").agg(F.count(F.lit(1)).alias(name))
    return items.join(counts, items[key] == counts["_key"], "left").drop("_key").withColumn(name, F.coalesce(name, F.lit(0)))


def ranked(items: DataFrame, *order: Column, name: str = "rn") -> DataFrame:
    """Items numbered from 1 in a total order, dealt out by range."""
    return placed(items, *order, name=name).withColumn(name, F.col(name).cast("int"))


def page(items: DataFrame, number: int | None, size: int | None, *order: Column) -> DataFrame:
    """One page; page and size are clamped (1 and up; 1 to 50, 24 unless given). Only the page's rows leave their tasks."""
    number, size = max(1 if number is None else number, 1), max(min(24 if size is None else size, 50), 1)
    upto = items.orderBy(*order).limit(number * size)
    numbered = upto.withColumn("rn", F.row_number().over(Window.orderBy(*order)))  # the pages so far, no more
    return numbered.where(F.col("rn") > (number - 1) * size)


def page_object(items: DataFrame, number: int, size: int, columns: list[str], *order: Column) -> DataFrame:
    """One row: page, page_size, total_count, rows (an array of structs in order, empty where the page is)."""
    total = items.agg(F.count(F.lit(1)).alias("total_count"))
    own = page(items, number, size, *order)
    rows = own.agg(F.array_sort(F.collect_list(F.struct("rn", *columns))).alias("rows"))
    return total.join(F.broadcast(rows)).select(F.lit(number).alias("page"), F.lit(size).alias("page_size"), "total_count", "rows")


def sort_keys(mode: str, end: str, created: str, views: str, scraps: str, recommended: str, place: str, bookmarked: str, ordinal: str) -> list[Column]:
    """Order of a list: recommended ones first by their places, then by the mode, then as they came."""
    pinned = [F.coalesce(F.col(recommended), F.lit(False)).desc(), F.asc_nulls_last(place)]
    by = {
        "deadline": [F.coalesce(F.col(bookmarked), F.lit(False)).desc(), F.asc(end)],
        "latest": [F.desc(created)],
        "views": [F.coalesce(F.col(views), F.lit(0)).desc()],
        "scraps": [F.coalesce(F.col(scraps), F.lit(0)).desc()],
    }
    return [*pinned, *by[mode], F.asc(ordinal)]


def place_ads(rows: DataFrame, group: str, position: str, key: str, is_ad: str, place: str) -> DataFrame:
    """Rows of each list with advertisements at the places they ask for; column `position` is renumbered from 0.

    Advertisements are put in one after the other, by place and key, each at its place or at the end, and shift what follows.
    Where everything ends up follows from counts, without a list in one row:

    - slots are taken from the left. The i-th advertisement asks for slot e = min(place, rows + i), and these grow with i; the
      slots that are taken are i + max(e - i so far).
    - advertisements that ask for one slot push each other on, the last one stays: who sits where is a stack, and a stack's
      n-th push to a depth is popped by its n-th pop from there.
    - the other rows fill the free slots in their order: a row with r rows before it stands behind the advertisements that have
      at most r free slots before them. Rows and advertisements sorted by that number are in their final order.

    Only advertisements meet in windows, list by list. Rows are dealt out by range of (list, order), so a list can be any size.
    """
    wants = F.coalesce(F.col(is_ad) & (F.col(place) > 0), F.lit(False))
    own = rows.select(F.col(group).alias("_list"), F.col(position).cast("bigint").alias("_at"), F.col(key).alias("_key"), F.col(place).cast("bigint").alias("_place"), wants.alias("_ad"))
    base = placed_within(own.where(~F.col("_ad")).select("_list", "_at", "_key"), ["_list"], F.asc("_at"), F.asc("_key"), name="_free", first=0)
    sizes = base.groupBy(F.col("_list").alias("_of")).agg(F.count(F.lit(1)).alias("_rows"))
    by = Window.partitionBy("_list").orderBy("_place", "_key")
    ads = own.where("_ad").select("_list", "_place", "_key", F.row_number().over(by).cast("bigint").alias("_i"))
    ads = ads.join(sizes, same(["_list"], ["_of"]), "left").withColumn("_asks", F.least("_place", F.coalesce("_rows", F.lit(0)) + F.col("_i")))
    ads = ads.withColumn("_free", F.max(F.col("_asks") - F.col("_i")).over(Window.partitionBy("_list").orderBy("_i")))

    event = lambda slot, pops, k: F.struct(slot.alias("slot"), F.lit(pops).alias("pops"), F.col("_i").alias("i"), k.alias("key"))
    each = ads.select("_list", F.inline(F.array(event(F.col("_asks"), 0, F.col("_key")), event(F.col("_free") + F.col("_i"), 1, F.lit(None).cast(dict(own.dtypes)["_key"])))))
    order = Window.partitionBy("_list").orderBy("slot", "pops", "i")
    deep = each.withColumn("_depth", F.sum(F.lit(1) - F.lit(2) * F.col("pops")).over(order) + F.col("pops"))
    nth = deep.withColumn("_nth", F.row_number().over(Window.partitionBy("_list", "_depth", "pops").orderBy("slot", "i")))
    seated = nth.groupBy("_list", "_depth", "_nth").agg(F.max("key").alias("_key"), F.max(F.when(F.col("pops") == 1, F.col("slot"))).alias("_slot"))

    line = base.select("_list", "_free", F.lit(1).alias("_kind"), "_key").unionByName(ads.select("_list", "_free", F.lit(0).alias("_kind"), "_key"))
    final = placed_within(line, ["_list"], F.asc("_free"), F.asc("_kind"), F.asc("_key"), name="_slot").where("_kind = 1")
    out = final.select("_list", "_slot", "_key").unionByName(seated.select("_list", "_slot", "_key"))
    return out.select(F.col("_list").alias(group), (F.col("_slot") - 1).cast("bigint").alias(position), F.col("_key").alias(key))
