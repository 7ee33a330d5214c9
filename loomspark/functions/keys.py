"""Identity and content keys of notices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import iso_head
from .text import clean_text
from .urls import normalise


def short_hash(x: Column, size: int) -> Column:
    return F.substring(F.sha2(x, 256), 1, size)


def canonical_key(source: Column, native_id: Column, url: Column, title: Column, posted: Column) -> Column:
    """By the native id, else by the address, else by title and day."""
    native, address = clean_text(native_id), normalise(url)
    dated = F.concat_ws("|", F.lower(clean_text(title)), F.coalesce(iso_head(posted), F.lit("undated")))
    return F.concat(
        source,
        F.when(native != "", F.concat(F.lit(":native:"), native))
        .when(address != "", F.concat(F.lit(":url:"), short_hash(address, 20)))
        .otherwise(F.concat(F.lit(":title-date:"), short_hash(dated, 20))),
    )


def content_hash(title: Column, posted: Column, body: Column) -> Column:
    """Of the JSON object of title, day and body; a missing day is a JSON null."""
    fields = F.struct(clean_text(title).alias("title"), iso_head(posted).alias("posted_at"), clean_text(body).alias("body_text"))
    return short_hash(F.to_json(fields, {"ignoreNullFields": "false"}), 32)


def asset_fingerprint(urls: Column) -> Column:
    """Of the JSON list of the normalised addresses, in their order."""
    return short_hash(F.to_json(F.transform(F.coalesce(urls, F.array().cast("array<string>")), normalise)), 20)


def url_key(url: Column) -> Column:
    return F.md5(url)
