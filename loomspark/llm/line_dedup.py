"""Lines that many documents share: range-partitioned hashes, first occurrences in a stream, keep bitmaps per document.

Only DataFrame functions. A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys are
128-bit hashes; they are dealt out by range with a salt from the document, so that a key that fills a third of all lines
meets in no one task, and sorted by document and position; a document's first occurrence is the row whose predecessor is
of another document. What goes back to the documents is a bitmap: 64 lines a word, words with nothing dropped left out.

A document is an id: rows that share one count once, whatever their texts. Rows without an id are documents by their text.

Cases: a null or empty text is one empty line, which is always kept; repeated rows come out as often as they came in; every
row loses its own lines, also where another row has its id; an empty table gives no rows; other columns travel in a struct,
so no name clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, identified, materialise

MIN_DOCS = 10
KEY = ["h1", "h2"]
DOC = ["doc", "body"]


def owner() -> list[Column]:
    """What is one document: the id, or else the text."""
    return [F.col("doc"), F.when(F.col("doc").isNull(), F.col("body")).alias("nameless")]


def salt(salts: int) -> Column:
    """Where a document's occurrences of a key are dealt to."""
    return F.pmod(F.xxhash64(*owner()), F.lit(salts)).cast("int").alias("salt")


def occurrences(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(h1, h2, doc, body, pos, n_lines) of every line whose key has at least min_chars code points."""
    lines = docs.select(*DOC, F.split(ascii_lower(F.col("text")), "\n", -1).alias("lines"))
    each = lines.select(*DOC, F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    key = F.btrim("line", F.lit(BLANKS))
    keyed = each.select(*DOC, "n_lines", "pos", key.alias("key")).where(F.char_length("key") >= max(1, min_chars))
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), *DOC, "pos", "n_lines")


def first_occurrences(lines: DataFrame, salts: int) -> DataFrame:
    """(h1, h2, salt, n): documents that hold a key, by salt, from a stream of range-partitioned, sorted occurrences."""
    ranged = lines.select(*KEY, salt(salts), *owner(), "pos").repartitionByRange(*KEY, "salt")
    stream = Window.partitionBy(*KEY, "salt").orderBy("doc", "nameless", "pos")
    before = F.lag(F.struct("doc", "nameless")).over(stream)
    first = before.isNull() | ~before.eqNullSafe(F.struct("doc", "nameless"))
    return ranged.withColumn("first", first).groupBy(*KEY, "salt").agg(F.count_if("first").alias("n"))


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, body, n_lines, keep map<int,bigint>) of the documents that lose lines; a set bit keeps its line."""
    spark = docs.sparkSession
    salts = max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines = materialise(occurrences(identified(docs, id_col, text), min_chars), "lines")
    by_salt = materialise(first_occurrences(lines, salts), "line-counts")
    common = by_salt.groupBy(*KEY).agg(F.sum("n").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    dropped = by_salt.join(common, KEY).select(*KEY, "salt")
    hit = lines.withColumn("salt", salt(salts)).join(dropped, [*KEY, "salt"], "left_semi")
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = hit.groupBy(*DOC, F.expr("CAST(pos DIV 64 AS INT)").alias("word")).agg(F.bit_or(bit).alias("bits"), F.max("n_lines").alias("n_lines"))
    entry = F.struct("word", F.bitwise_not("bits"))
    return words.groupBy(*DOC).agg(F.max("n_lines").alias("n_lines"), F.map_from_entries(F.collect_list(entry)).alias("keep"))


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, n_lines, n_dropped, kept): the rows as structs, so that no column clashes, and the lines that stay, joined by line feeds."""
    maps = keep_bitmaps(docs.select(id_col, text), min_docs, min_chars, id_col, text)
    dense = F.expr("transform(sequence(0, (n_lines - 1) DIV 64), w -> coalesce(keep[CAST(w AS INT)], -1L))")
    maps = materialise(maps.select("doc", "body", dense.alias("words")), "bitmaps")
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"), F.col(id_col).alias("_doc"), F.xxhash64(whole).alias("_body"))
    joined = rows.join(maps, F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_body") == F.col("body")), "left")
    # the text goes through the shuffle once, inside its row
    joined = joined.withColumn("text", F.coalesce(F.col("row").getField(text), F.lit("")))
    lines = joined.withColumn("lines", F.split("text", "\n", -1))
    stay = F.expr("filter(lines, (x, i) -> getbit(element_at(words, CAST(i DIV 64 AS INT) + 1), i % 64) = 1)")
    kept = lines.withColumn("stay", F.when(F.col("words").isNotNull(), stay))
    dropped = F.when(F.col("words").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size("stay")).cast("bigint")
    left = F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join("stay", "\n"))
    return kept.select("row", F.size("lines").cast("bigint").alias("n_lines"), dropped.alias("n_dropped"), left.alias("kept"))
