"""Sources whose lists come as JSON (or as a plain page of links): where their items, ids, titles, days and addresses are.

An adapter is data; `feed_items` reads any of them. Fetching is not done here: a feed is a table of responses.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dom import parse
from ..functions.text import clean_text
from ..functions.udfs import batch_udf
from ..functions.urls import resolve
from ..operators.notices import first_n, first_wins


@dataclass(frozen=True)
class Adapter:
    """`items` leads to the list; fields are synonyms, the first that is not blank counts. `address` is a path under the list's
    origin, with {id}; `stops_at_first` says whether a first page without recent items already ends the reading, `once`
    whether an id that comes again is left out."""

    items: str
    id: tuple[str, ...]
    title: tuple[str, ...]
    day: tuple[str, ...]
    address: str
    content: tuple[str, ...] = ("content",)
    link: tuple[str, ...] = ()
    link_if: str = ""
    form: tuple[str, ...] = ()
    category: tuple[str, ...] = ()
    writer: tuple[str, ...] = ()
    stops_at_first: bool = False
    once: bool = True


# The adapters by the names under which sources are registered.
ADAPTERS = {
    "cau_portal": Adapter(
        items="$.data.list", id=("BBS_SEQ",), title=("SUBJECT",), day=("WRITE_DATE", "WRITE_DT"), address="/cms/FR_CON/BoardView.do", form=("MENU_ID", "SITE_NO", "BOARD_SEQ"),
        link=("LINK_URL",), link_if="LINK_URL_YN", category=("CATEGORY_NM1", "CATEGORY_NM2"), writer=("WRITER_NM",), content=(),
    ),
    "cau_artech": Adapter(items="$.data.newsList", id=("id",), title=("title",), day=("createdAt", "updatedAt"), address="/news/{id}", once=False),
    "hanyang_is": Adapter(items="$.notices", id=("_id",), title=("title",), day=("createdAt", "updatedAt"), address="/notices/{id}"),
    "korea_medicine": Adapter(items="$.list", id=("articleNo",), title=("title",), day=("modifiedDt", "createdDt"), address="/kr/college/notice/view.do?articleNo={id}", stops_at_first=True),
    "yonsei_communication": Adapter(items="$", id=("id",), title=("title",), day=("date",), address="/notice.html?id={id}", content=("contentfile",), once=False),
    "yonsei_uic": Adapter(items="$", id=("href",), title=("text",), day=("date",), address="{id}"),
}


def adapter(name: str | None) -> Adapter | None:
    return ADAPTERS.get(" ".join((name or "").split()).lower())


def filled(item: Column, names: tuple[str, ...]) -> Column:
    """The first of a JSON text's fields that is not blank."""
    return F.coalesce(*(F.nullif(clean_text(F.get_json_object(item, f"$.{n}")), F.lit("")) for n in names), F.lit(None).cast("string"))


def instant(text: Column) -> Column:
    """A moment out of a date, an ISO time or milliseconds; null for anything else."""
    millis = F.when(text.rlike(r"^\d{10,}$"), F.timestamp_millis(text.try_cast("bigint")))
    dotted = F.regexp_extract(text, r"^(\d{4})[./-](\d{1,2})[./-](\d{1,2})", 0)
    day = F.try_to_timestamp(F.regexp_replace(dotted, "[./]", "-"), F.lit("yyyy-M-d"))
    named = F.try_to_timestamp(text, F.lit("MMM d, yyyy"))
    return F.coalesce(millis, F.when(text.contains("T"), text.try_cast("timestamp")), day, named)


def uic_links(html: str | None) -> list[dict]:
    """Links to single notices of a page that is no JSON; a date in brackets at the end of a link is its day."""
    out = []
    for link in parse(html).find("a[href*='act=view'][href*='uid=']"):
        text = link.text()
        dated = re.search(r"\(([A-Z][a-z]{2}\s+\d{1,2},\s+\d{4})\)\s*$", text)
        out.append({"href": link.get("href"), "text": text[: dated.start()].strip() if dated else text, "date": dated.group(1) if dated else ""})
    return out


@batch_udf("array<struct<href:string,text:string,date:string>>")
def uic_items(html: pd.Series) -> pd.Series:
    return html.map(uic_links)


def links_as_json(feed: DataFrame, body: str) -> DataFrame:
    """A feed of such pages as one of JSON lists, for the adapter `yonsei_uic`."""
    return feed.withColumn(body, F.to_json(uic_items(F.col(body))))


def address(a: Adapter, item: Column, key: Column, list_url: Column, form: Column | None) -> Column:
    """Where an item leads: its own link if it says so, else a path under the list's origin with its id."""
    origin = F.regexp_extract(list_url, r"^(https?://[^/?#]+)", 1)
    if a.address == "{id}":
        return resolve(key, list_url, list_url)
    own = F.concat(origin, *(x for part in re.split(r"(\{id\})", a.address) if part for x in [key if part == "{id}" else F.lit(part)]))
    if a.form:
        kept = [F.when(F.coalesce(form.getItem(n), F.lit("")) != "", F.concat(F.lit(f"{n}="), form.getItem(n))) for n in a.form] if form is not None else []
        own = F.concat(own, F.lit("?"), F.concat_ws("&", *kept, F.concat(F.lit(f"{a.id[0]}="), key)))
    if not a.link:
        return own
    out = F.when(F.upper(filled(item, (a.link_if,))) == "Y", filled(item, a.link))
    return F.coalesce(F.nullif(resolve(out, list_url, list_url), F.lit("")), own)


def feed_items(feed: DataFrame, a: Adapter, body: str = "body", as_of: str | None = None, lookback_days: int | None = None, keep_undated: bool = False, cap: int | None = None, form: str | None = None) -> DataFrame:
    """Items of list responses: source_key, page, id, title, url, date_text, content, in the source's order.

    feed has source_key, list_url, page and `body` (JSON), for forms also a map column. Items without id or title go, and
    with `as_of` those outside the days before it; ids count once. Reading a source stops behind a page that brings nothing
    (the first page may, unless the adapter says otherwise, if it has items at all), and at `cap` items.
    """
    lists = feed.select("source_key", "list_url", "page", *([F.col(form).alias("_form")] if form else []), F.from_json(F.get_json_object(body, a.items), "array<string>").alias("_items"))
    each = lists.select("*", F.posexplode("_items").alias("_nth", "_item"))
    item = F.col("_item")
    rows = each.select("source_key", "list_url", "page", "_nth", "_item", *(["_form"] if form else []), filled(item, a.id).alias("id"), filled(item, a.title).alias("title"), filled(item, a.day).alias("date_text"))
    rows = rows.where(F.col("id").isNotNull() & F.col("title").isNotNull()).withColumn("_order", F.struct("page", "_nth"))
    if as_of is not None:
        now = F.to_timestamp(F.lit(as_of))
        recent = instant(F.col("date_text")).between(now - F.expr(f"INTERVAL {int(lookback_days or 31)} DAYS"), now)
        rows = rows.where(F.coalesce(recent, F.lit(keep_undated)))
    rows = first_wins(rows, ["source_key", "id"], "_order") if a.once else rows
    brought = rows.groupBy("source_key", "page").agg(F.count(F.lit(1)).alias("_n"))
    empty = F.coalesce(F.size("_items"), F.lit(0)) <= 0
    silent = lists.join(brought, ["source_key", "page"], "left").where(F.col("_n").isNull() & (empty | (F.col("page") > 1) | F.lit(a.stops_at_first)))
    stops = silent.groupBy("source_key").agg(F.min("page").alias("_stop"))
    rows = rows.join(stops, "source_key", "left").where(F.col("_stop").isNull() | (F.col("page") < F.col("_stop"))).drop("_stop")
    rows = first_n(rows, ["source_key"], "_order", cap) if cap else rows
    label = F.nullif(F.concat_ws("/", *(filled(item, (n,)) for n in a.category)), F.lit("")) if a.category else F.lit(None).cast("string")
    content = F.concat_ws(" ", F.concat(F.lit("["), label, F.lit("]")), filled(item, a.writer)) if a.category else filled(item, a.content)
    url = address(a, item, F.col("id"), F.col("list_url"), F.col("_form") if form else None)
    return rows.select("source_key", "page", "id", "title", url.alias("url"), "date_text", content.alias("content"))
