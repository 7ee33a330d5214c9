"""SQL as text: rows as seed statements, and what a schema's text says about the keys that an upsert may name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A table of a schema's text with its body, and the keys in it.
TABLE = r"(?is)create table if not exists public\.([a-z0-9_]+)\s*\((.*?)\n\);"
UNIQUE = r"(?i)(?:constraint\s+[a-z0-9_]+\s+)?unique\s*\(([^)]+)\)"
PRIMARY = r"(?i)primary key\s*\(([^)]+)\)"


def literal(value: Column, cast: str = "", kind: str = "text") -> Column:
    """A value as an SQL literal: texts and JSON in quotes, numbers and booleans as they are, nothing as null."""
    text = value.cast("string")
    shown = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'")) if kind in ("text", "json") else text
    mark = cast or ("jsonb" if kind == "json" else "")
    return F.coalesce(F.concat(shown, F.lit(f"::{mark}")) if mark else shown, F.lit("null"))


def seed_statements(rows: DataFrame, table: str, key: str, columns: dict[str, tuple[str, str]], per_statement: int = 500) -> DataFrame:
    """(part, statement): idempotent inserts in the order of the key, so many rows each; columns are name -> (kind, cast).

    A row is inserted only where its key is not there yet. Rows are dealt to statements by their place, worked out without a
    global sort of whole rows: keys alone are numbered.
    """
    from ..operators.reports import numbered_keys

    names = ", ".join(columns)
    values = F.concat(F.lit("("), F.concat_ws(", ", *(literal(F.col(c), cast, kind) for c, (kind, cast) in columns.items())), F.lit(")"))
    placed = numbered_keys(rows, key).withColumn("part", F.expr(f"CAST((_place - 1) DIV {int(per_statement)} AS INT)"))
    parts = placed.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("_place", values.alias("v")))).alias("_rows"))
    head = F.lit(f"insert into public.{table} ({names})\nselect {', '.join(f'v.{c}' for c in columns)} from (values\n  ")
    tail = F.lit(f"\n) as v ({names})\nwhere not exists (select 1 from public.{table} t where t.{key} = v.{key});")
    return parts.select("part", F.concat(head, F.array_join(F.transform("_rows", lambda r: r["v"]), ",\n  "), tail).alias("statement"))


def normal_target(text: Column) -> Column:
    """The columns of a key: trimmed, without quotes, joined by commas."""
    each = F.transform(F.split(text, ","), lambda p: F.regexp_replace(F.trim(F.regexp_replace(p, r"\s+", " ")), '^"|"$', ""))
    return F.array_join(F.filter(each, lambda p: p != ""), ",")


def conflict_targets(schemas: DataFrame, text: str) -> DataFrame:
    """(table_name, targets): the unique and primary keys of every table in the text of a schema, unique ones first."""
    tables = F.arrays_zip(F.regexp_extract_all(F.col(text), F.lit(TABLE), 1).alias("name"), F.regexp_extract_all(F.col(text), F.lit(TABLE), 2).alias("body"))
    each = schemas.select(F.explode(tables).alias("t")).select(F.col("t.name").alias("table_name"), F.col("t.body").alias("body"))
    found = F.concat(F.regexp_extract_all("body", F.lit(UNIQUE), 1), F.regexp_extract_all("body", F.lit(PRIMARY), 1))
    return each.select("table_name", F.transform(found, normal_target).alias("targets")).where(F.size("targets") > 0)


def preflight(wanted: DataFrame, targets: DataFrame) -> DataFrame:
    """wanted (table_name, target) with `ok`: whether the schema has that key, and the keys that it has."""
    own = wanted.select("table_name", normal_target(F.col("target")).alias("target")).join(targets, "table_name", "left")
    keys = F.coalesce("targets", F.array().cast("array<string>"))
    return own.select("table_name", "target", keys.alias("targets"), F.array_contains(keys, F.col("target")).alias("ok"))
