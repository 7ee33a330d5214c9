"""Two lists of names held against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import placed


def canonical(names: DataFrame, column: str, aliases: dict[str, str], excluded: list[str] | None = None) -> DataFrame:
    """Distinct names with aliases replaced, blank and excluded ones gone."""
    table = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv)) if aliases else None
    own = F.trim(column)
    own = F.coalesce(F.element_at(table, own), own) if table is not None else own
    out = names.select(own.alias("name")).where(F.col("name") != "")
    return (out.where(~F.col("name").isin(excluded)) if excluded else out).distinct()


def full(left: DataFrame, right: DataFrame, left_only: str, right_only: str) -> DataFrame:
    """(name, status) of every name of two lists of distinct names."""
    a, b = left.withColumn("_l", F.lit(True)), right.withColumn("_r", F.lit(True))
    status = F.when(F.col("_l") & F.col("_r"), "overlap").when(F.col("_l"), left_only).otherwise(right_only)
    return a.join(b, "name", "full").select("name", status.alias("status"))


def summary(compared: DataFrame, left_only: str, right_only: str) -> DataFrame:
    """One row of counts."""
    count = lambda *s: F.count_if(F.col("status").isin(*s))
    return compared.agg(
        count("overlap", left_only).alias("left_count"), count("overlap", right_only).alias("right_count"), count("overlap").alias("overlap_count"),
        count(left_only).alias("left_only_count"), count(right_only).alias("right_only_count"),
    )


def collated(names: DataFrame, column: str, locale: str = "ko", place: str | None = None) -> DataFrame:
    """Names in the order of a language, those that it takes for equal by their code points; with `place`, their places in it."""
    order = F.collate(F.col(column), locale).asc(), F.asc(column)
    return names.orderBy(*order) if place is None else placed(names, *order, name=place)


def required(wanted: DataFrame, key: str, existing: DataFrame, existing_key: str) -> DataFrame:
    """Wanted keys with is_present."""
    have = existing.select(F.col(existing_key).alias(key)).distinct().withColumn("is_present", F.lit(True))
    return wanted.join(have, key, "left").withColumn("is_present", F.coalesce("is_present", F.lit(False)))
