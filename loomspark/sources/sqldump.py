"""Rows of INSERT statements in SQL dumps, a file in as many tasks as it has splits.

A split is cut into blocks at the lines that begin a statement, and a block is scanned as if it began outside of any value. A
block that ends inside a value (whose text has such a line) goes on into the next one. What lies before a split's first
beginning belongs to the last block of the split before; these seams, one a split, are put together and scanned on their own.
If all seams of a file end outside of values, by induction every split did begin where it was taken to begin, and all is found.
A file with a seam that ends inside a value is read again, whole, in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import written

START = re.compile(r"insert\s+into\s+(?:public\.)?\"?(\w+)\"?\s*\(([^)]*)\)\s*values\s*", re.I)
BEGINS = re.compile(r"\s*insert\s+into\b", re.I)
MORE = re.compile(r"\s*,\s*")
#: A whole quoted text, a quote that is never closed, a bracket or a comma.
TOKEN = re.compile(r"'[^']*(?:''[^']*)*'|[\[\](),']")
CAST = re.compile(r"::[\w\"\[\]. ]+$")

FOUND = "path string, start bigint, kind int, nth bigint, table_name string, fields map<string,string>, text string, is_open boolean"
#: What a row of FOUND is: a row of a seam, a row of the split's own, what comes before the first beginning, the last block
#: (or one of its rows).
SEAM, OWN, HEAD, TAIL = 0, 1, 2, 3


def split_level(text: str, at: int, end: str) -> tuple[list[str], int, bool]:
    """Comma-separated parts of a bracket's inside from `at` up to its `end`, which may hold quotes and brackets; where it ends,
    and whether it does."""
    parts, begin, depth = [], at, 0
    for token in TOKEN.finditer(text, at):
        c = token[0]
        if c == "'":
            break
        if c in "([":
            depth += 1
        elif c in ")]" and depth:
            depth -= 1
        elif c == end and not depth:
            parts.append(text[begin : token.start()].strip())
            return parts, token.end(), True
        elif c == "," and not depth:
            parts.append(text[begin : token.start()].strip())
            begin = token.end()
    return parts, len(text), False


def literal(value: str) -> str | None:
    """A literal as text: NULL is null, quotes and casts come off, anything else stays."""
    value = CAST.sub("", value.strip())
    if value.upper() == "NULL":
        return None
    if len(value) > 1 and value[0] == value[-1] == "'":
        return value[1:-1].replace("''", "'")
    return value


def statements(text: str) -> tuple[list[tuple[str, dict]], bool]:
    """[(table, {column: text})] of every row of every INSERT ... VALUES, and whether the text ends inside a row."""
    rows, is_open, at = [], False, 0
    while found := START.search(text or "", at):
        columns, at = [c.strip().strip('"') for c in found.group(2).split(",")], found.end()
        while text[at : at + 1] == "(":
            values, at, closed = split_level(text, at + 1, ")")
            rows.append((found.group(1), dict(zip(columns, map(literal, values), strict=False))))
            is_open = is_open or not closed
            more = MORE.match(text, at)
            if not more:
                break
            at = more.end()
    return rows, is_open


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.bool_())
    names = [c.split()[0] for c in FOUND.replace("map<string,string>", "map").split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array([list(x.items()) if isinstance(x, dict) else x for x in c], k) for c, k in zip(columns, kinds, strict=True)], names=names)


class Scanner:
    """Blocks of one split, line by line."""

    def __init__(self, path: str, start: int):
        self.path, self.start, self.nth, self.begun, self.lines = path, start, 0, False, []

    def row(self, kind: int, table: str | None, fields: dict | None, text: str | None, is_open: bool) -> tuple:
        self.nth += 1
        return self.path, self.start, kind, self.nth - 1, table, fields, text, is_open

    def line(self, line: str) -> Iterator[tuple]:
        if BEGINS.match(line):
            yield from self.block(last=False)
        self.lines.append(line)

    def block(self, last: bool) -> Iterator[tuple]:
        """What a block gives when it ends at the beginning of another, or with the split."""
        text = "\n".join(self.lines)
        if not self.begun:
            # a head is there in every split, so that the seams before and after it are told apart
            yield self.row(HEAD, None, None, text, not last)
            self.begun, self.lines = not last, []
        elif last:
            yield self.row(TAIL, None, None, text, False)
        else:
            rows, is_open = statements(text)
            if not is_open:
                yield from (self.row(OWN, t, f, None, False) for t, f in rows)
                self.lines = []


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out = None, []
    for batch in batches:
        for line, path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or (path, start) != (now.path, now.start):
                out += now.block(last=True) if now else ()
                now = Scanner(path, start)
            out += now.line(line)
        yield as_batch(out)
        out = []
    if now:
        yield as_batch(list(now.block(last=True)))


def seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path, start, kind, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows, is_open = statements(text)
            out += [(path, start, kind, k, t, f, None, is_open) for k, (t, f) in enumerate(rows)] or [(path, start, kind, 0, None, None, None, is_open)]
        yield as_batch(out)


def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield as_batch([(path, 0, OWN, k, t, f, None, False) for k, (t, f) in enumerate(statements(text)[0])])


def dump_rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, ordinal, table_name, fields) of all rows of the dumps in a folder; ordinals count a file's rows from 0."""
    meta = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    lines = spark.read.text(path, lineSep="\n").select("value", *meta)
    found = written(lines.mapInArrow(scan, FOUND))
    # a head with the last block before it: splits without a beginning are all head, and belong to the same seam
    order = Window.partitionBy("path").orderBy("start", "kind_order")
    edges = found.where(F.col("kind").isin(HEAD, TAIL)).withColumn("kind_order", F.col("kind"))
    edges = edges.withColumn("seam", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "kind_order", "text"))), lambda x: x["text"]), "\n")
    joined = edges.groupBy("path", "seam").agg(text.alias("text"), F.max(F.struct("start", "kind_order", "is_open")).alias("last"))
    # rows of a file's last block come after its split's own, those of any other seam before
    kind = F.when(F.col("last.kind_order") == HEAD, SEAM).otherwise(TAIL).cast("int")
    joined = joined.select("path", "last.start", kind.alias("kind"), "text", F.col("last.is_open").alias("goes_on"))
    scanned = written(joined.select("path", "start", "kind", "text").mapInArrow(seams, FOUND))
    # a seam that ends inside a value, though statements of its split were taken to begin after it
    stuck = scanned.where("is_open").select("path", "start", "kind").distinct().join(joined.where("goes_on").select("path", "start", "kind"), ["path", "start", "kind"]).select("path").distinct()
    stuck = written(stuck)
    rows = found.where(F.col("kind") == OWN).unionByName(scanned.where("table_name IS NOT NULL"))
    if not stuck.isEmpty():
        again = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").join(stuck, "path", "left_semi")
        rows = rows.join(stuck, "path", "left_anti").unionByName(again.mapInArrow(whole, FOUND))
    counts = rows.groupBy("path", "start", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    before = Window.partitionBy("path").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).drop("n", "first")
    return rows.join(counts, ["path", "start", "kind"]).select("path", (F.col("nth") + F.col("shift")).cast("int").alias("ordinal"), "table_name", "fields")


def read_dump(spark: SparkSession, path: str, table: str, columns: list[str]) -> DataFrame:
    """Rows of one table of the dumps in a folder, with the columns asked for, null where a statement lacks one."""
    rows = dump_rows(spark, path).where(F.col("table_name") == table)
    return rows.select("ordinal", *(F.col("fields").getItem(c).alias(c) for c in columns))
