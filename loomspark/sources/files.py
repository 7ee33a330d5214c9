"""Readers and writers of the files that the pipeline exchanges."""

from __future__ import annotations

import re
import tempfile
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "﻿"
DATED = r"-(\d{8})\.[a-z]+$"

ASSET = "struct<asset_type:string,filename:string,source_url:string,content_type:string,alt:string,caption:string>"
ITEM = f"struct<title:string,discovered_url:string,canonical_url:string,published_at:string,body_text:string,body_html:string,body_quality:string,raw_list_text:string,native_post_id:string,assets:array<{ASSET}>,warnings:array<string>,errors:array<string>>"
RUN_DOCUMENT = f"run struct<run_key:string,started_at:string,mode:string,parser_version:string>, sources array<struct<source_key:string,items:array<{ITEM}>>>"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as texts; quotes doubled inside quotes, line ends inside quotes, a byte order mark, rows of blanks left out."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    filled = [F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))) != "" for c in df.columns]
    any_filled = filled[0]
    for f in filled[1:]:
        any_filled = any_filled | f
    return df.where(any_filled)


def csv_line(columns: list[Column]) -> Column:
    """One CSV line: a cell is quoted if it holds a comma, a quote or a line end."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    cell = lambda c: F.when(text(c).rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(text(c), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text(c))
    return F.concat_ws(",", *map(cell, columns))


def write_csv(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """Files with a byte order mark, a header and CRLF line ends, as spreadsheets want them; rows in order over the files, as many
    as the sort has partitions. Each file is whole by itself, and `read_csv` reads the folder."""
    head = BOM + ",".join(f'"{c}"' if re.search('[",\r\n]', c) else c for c in df.columns)
    if df.isEmpty():
        df.sparkSession.range(1).select(F.lit(head).alias("value")).write.mode("overwrite").option("lineSep", "\r\n").text(path)
        return
    # the row that a partition begins with, after the sort, takes the header along
    begins = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = (df.orderBy(*order) if order else df).select(csv_line([F.col(f"`{c}`") for c in df.columns]).alias("value"), begins.alias("_first"))
    value = F.when(F.col("_first"), F.concat(F.lit(head + "\r\n"), "value")).otherwise(F.col("value"))
    lines.select(value.alias("value")).write.mode("overwrite").option("lineSep", "\r\n").text(path)


def read_json(spark: SparkSession, path: str, schema: str | T.StructType, lines: bool = False) -> DataFrame:
    """One document, or one a line."""
    return spark.read.schema(schema).json(path, multiLine=not lines)


def write_report(df: DataFrame, root: str, day: date) -> None:
    """A dated copy and the latest one."""
    for name in (f"dt={day:%Y%m%d}", "latest"):
        df.write.mode("overwrite").json(f"{root}/{name}")


def read_last_days(spark: SparkSession, root: str, schema: str, n: int) -> DataFrame:
    """Reports of the last n days that there are, from a folder of dt=YYYYMMDD."""
    rows = spark.read.schema(f"{schema}, dt string").option("basePath", root).json(f"{root}/dt=*")
    keep = rows.select("dt").distinct().orderBy(F.desc("dt")).limit(n)
    return rows.join(F.broadcast(keep), "dt", "left_semi")


def run_items(documents: DataFrame) -> DataFrame:
    """One row per item of run documents, with its source and its place in it; sources without items have none."""
    each = documents.select("run.run_key", F.posexplode("sources").alias("source_index", "_s"))
    return each.select("run_key", "source_index", F.lower(F.trim("_s.source_key")).alias("source_key"), F.posexplode("_s.items").alias("item_index", "item"))


def detect_shapes(spark: SparkSession, path: str) -> DataFrame:
    """(path, shape) of every document in a folder, a file each. Each document is looked at in the task that reads it."""
    return shapes(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value"))


def detect_packed_shapes(spark: SparkSession, path: str) -> DataFrame:
    """The same for documents that lie many to a file, a line of JSON (path, value) each: files grow with bytes, not with documents."""
    return shapes(spark.read.schema("path string, value string").json(path))


def shapes(documents: DataFrame) -> DataFrame:
    """(path, shape) of documents (path, value), by the fields at their top: collector-output, synthetic-compatible,
    collector-report or candidate-list."""
    head = documents.select("path", F.ltrim(F.regexp_replace("value", f"^{BOM}", "")).alias("t"))
    is_list = lambda name: F.startswith(F.ltrim(F.coalesce(F.get_json_object("t", f"$.{name}"), F.lit(""))), F.lit("["))
    version = F.coalesce(F.get_json_object("t", "$.collector_output_version"), F.lit("")) != ""
    shape = (
        F.when(is_list("sources") & version, "collector-output")
        .when(is_list("sources"), "synthetic-compatible")
        .when(is_list("newNotices") | is_list("perSource"), "collector-report")
        .otherwise("candidate-list")
    )
    return head.select("path", shape.alias("shape"))


def workspace(spark: SparkSession) -> str:
    """A folder that driver and executors share, for tables that are written to be read again: spark.checkpoint.dir. Only where
    the master is local and the setting unset is there one of our own; on a cluster a folder of this machine would be empty on
    all others, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="loomspark-")
        spark.conf.set("spark.checkpoint.dir", found)
    path = f"{found}/loomspark-files-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def written(df: DataFrame) -> DataFrame:
    """The rows, written and read back: what they came from is not computed again, and a lost executor costs a task."""
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PAGE_HEAD = """<!DOCTYPE html>
<html lang="{lang}">
<head>
  <meta charset="utf-8" />
  <title>{title}</title>
  <style>table {{ border-collapse: collapse; width: 100%; }} th, td {{ border: 1px solid #888; padding: 4px; vertical-align: top; }}</style>
</head>
<body>
  <h1>{title}</h1>
  <table>
    <thead><tr>{cells}</tr></thead>
    <tbody>"""
PAGE_TAIL = "    </tbody>\n  </table>\n</body>\n</html>"


def markup(value: Column) -> Column:
    """A text as the content of an element, line ends as breaks."""
    out = F.coalesce(value.cast("string"), F.lit(""))
    for raw, by in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "<br/>")):
        out = F.replace(out, F.lit(raw), F.lit(by))
    return out


def table_row(columns: list[Column]) -> Column:
    return F.concat(F.lit("<tr>"), *(x for c in columns for x in (F.lit("<td>"), markup(c), F.lit("</td>"))), F.lit("</tr>"))


def write_word(df: DataFrame, path: str, title: str, order: list[Column] | None = None, lang: str = "ko") -> None:
    """A document that word processors open, a byte order mark first, as parts that make it up in the order of their names: the
    head is the first line of the sort and the end its last, so no task has all rows."""
    shown = df.sparkSession.range(1).select(*(markup(F.lit(x)) for x in (title, *df.columns))).first()
    head = BOM + PAGE_HEAD.format(lang=lang, title=shown[0], cells="".join(f"<th>{c}</th>" for c in shown[1:]))
    edges = df.sparkSession.createDataFrame([(head, 0), (PAGE_TAIL, 2)], "_fixed string, _kind int")
    rows = df.withColumns({"_kind": F.lit(1), "_n": F.monotonically_increasing_id(), "_fixed": F.lit(None).cast("string")}).unionByName(edges, allowMissingColumns=True)
    lines = rows.orderBy("_kind", *(order or [F.asc("_n")])).select(F.coalesce("_fixed", table_row([F.col(f"`{c}`") for c in df.columns])).alias("value"))
    lines.write.mode("overwrite").text(path)
