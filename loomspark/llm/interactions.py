"""What quality filters do together: every order of the filters, step by step, from one packed bitmap index.

Per document there is a bit for each filter that it fails and for each label. Within a partition the bits are packed into words
of 64, the rows of each part (a value of a column) in words of their own, so that a part is a run of words. For each subset of
the filters the rows that pass all of it are the AND NOT of its bitmaps; set bits are counted word by word and added up over the
runs. A task gives a row of counts for each part that it has seen, and the counts of all tasks are added up: one sum by part,
combined before the shuffle. What any order of the filters does at any step follows from the counts of subsets alone.

The filters on single texts work in Arrow batches, beside the scan. That a text stands under a smaller id is found by keys:
the least id of each text that stands more than once, joined by the text's 256-bit hash (a join whose hot keys Spark splits,
since both sides are read from files). Texts do not move.

Cases: a null text is an empty one; a null part is the empty string; a null id has no label, is no smaller id, and its text is
not taken for a copy; rows that share id and text are no copies of each other; labels that repeat an id hold if any of its rows
has them; an empty table gives no rows; other columns are not read, so no name clashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, materialise, short_batches

FILTERS = "ABCDE"
ODD = re.compile("[#$%&*|]")
CAPITAL = bytes(range(65, 91))
COUNTS = ("kept", "good", "toxic")
#: Rows that are packed at once: their bitmaps take 7 bits a row.
INDEX_ROWS = 1 << 20


def text_failures(texts: list[str | None]) -> list:
    """[bits]: 1 under 200 words, 2 under half of them different, 4 over two per cent capitals, 8 odd characters."""
    found = []
    for text in texts:
        raw = (text or "").encode()
        words = raw.split()
        n, chars = len(words), len(text or "")
        capitals = len(raw) - len(raw.translate(None, CAPITAL))
        few = 100 * len(set(words)) < 50 * n
        found.append((n < 200) | few << 1 | (100 * capitals > 2 * chars) << 2 | (ODD.search(text or "") is not None) << 3)
    return [pa.array(found, pa.int32())]


def copies(rows: DataFrame, doc: str, key: str) -> DataFrame:
    """(key, _first): the least id of each text that several rows have."""
    each = rows.groupBy(key).agg(F.min(doc).alias("_first"), F.count(F.lit(1)).alias("_n"))
    return materialise(each.where("_n > 1 AND _first IS NOT NULL").select(key, "_first"), "copies")


def failures(docs: DataFrame, labels: DataFrame, part: str = "source", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, fails, good, toxic) of every document; `fails` has a bit for each filter."""
    own = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    own = own.withColumn("body", F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))
    rows = materialise(map_texts(own, text_failures, "fails int", "doc", "part", "body"), "failures")
    seen = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_doc")).agg(*(F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))))
    seen = materialise(seen.where("good OR toxic"), "labelled")
    first = copies(rows, "doc", "body")
    marked = rows.join(first, "body", "left").withColumn("fails", F.col("fails").bitwiseOR(F.when(F.col("doc") > F.col("_first"), 16).otherwise(0)))
    joined = marked.select("doc", "part", "fails").join(seen, F.col("doc") == F.col("_doc"), "left")
    return joined.select("part", "fails", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))


def packed(flags: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """A bitmap of `words` words of 64 bits with the bits `at` of the rows whose flag is set."""
    bits = np.zeros(words * 64, np.uint8)
    bits[at[flags]] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def subset_counts(parts: np.ndarray, fails: np.ndarray, good: np.ndarray, toxic: np.ndarray, n_parts: int, filters: int) -> np.ndarray:
    """counts[part, label, subset]: rows, good rows and toxic rows of a part that pass every filter of the subset."""
    order = np.argsort(parts, kind="stable")
    parts, fails, good, toxic = parts[order], fails[order], good[order], toxic[order]
    sizes = np.bincount(parts, minlength=n_parts)
    spans = (sizes + 63) // 64  # words of each part
    starts = np.cumsum(spans) - spans
    at = np.arange(len(parts)) + np.repeat(starts * 64 - (np.cumsum(sizes) - sizes), sizes)
    words = int(spans.sum())
    live = [packed(np.ones(len(parts), bool), at, words), packed(good, at, words), packed(toxic, at, words)]
    failing = [packed((fails >> f) & 1 == 1, at, words) for f in range(filters)]
    out = np.zeros((n_parts, len(live), 1 << filters), np.int64)
    passing = {0: np.full(words, ~np.uint64(0))}
    for subset in range(1 << filters):
        if subset:
            last = subset.bit_length() - 1
            passing[subset] = passing[subset ^ (1 << last)] & ~failing[last]
        for k, bitmap in enumerate(live):
            out[:, k, subset] = np.add.reduceat(np.bitwise_count(bitmap & passing[subset]).astype(np.int64), starts) if words else 0
    return out


def indexed(rows: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """(part, counts) summed up over all tasks: rows, good and toxic ones that pass each subset of the filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def count(table: pa.Table) -> Iterator[pa.RecordBatch]:
            names = table.column("part").combine_chunks().dictionary_encode()
            fails, good, toxic = (table.column(c).to_numpy() for c in ("fails", "good", "toxic"))
            found = subset_counts(names.indices.to_numpy(), fails, good, toxic, len(names.dictionary), filters)
            width = found.shape[1] * found.shape[2]
            for first in range(0, len(names.dictionary), 4096):
                own = found[first : first + 4096].reshape(-1)
                ends = np.arange(0, len(own) + 1, width, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([names.dictionary[first : first + 4096], pa.ListArray.from_arrays(pa.array(ends), pa.array(own))], names=["part", "counts"])

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= INDEX_ROWS:
                yield from count(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield from count(pa.Table.from_batches(held))

    counted = rows.mapInArrow(run, "part string, counts array<bigint>")
    width = len(COUNTS) << filters
    sums = counted.groupBy("part").agg(*(F.sum(F.get("counts", F.lit(i))).alias(f"_{i}") for i in range(width)))
    return sums.select("part", *(F.array(*(f"_{(k << filters) + s}" for s in range(1 << filters))).alias(c) for k, c in enumerate(COUNTS)))


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, its filter, subset of the filters before it) for each step of each order of the filters."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(filters[i] for i in order), step, f, before))
            before |= 1 << f
    return out


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and
    shapley (what the step's filter removes, summed over all orders), of the rows of `failures`."""
    full = (1 << len(filters)) - 1
    steps = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(f).alias("f"), F.lit(b).alias("b")) for o, s, f, b in orders(filters)))
    pick = lambda c, s: F.get(F.col(c), s.cast("int") if isinstance(s, Column) else F.lit(s))
    bit = [1 << f for f in range(len(filters))]
    removed_in = lambda f, b: pick("kept", b) - pick("kept", b | bit[f])
    # the weight of a subset before a filter is the number of orders that have it there
    weights: dict[tuple[int, int], int] = {}
    for _, _, f, b in orders(filters):
        weights[f, b] = weights.get((f, b), 0) + 1
    shapley = F.array(*(sum((removed_in(f, b) * F.lit(w) for (g, b), w in weights.items() if g == f), F.lit(0)) for f in range(len(filters))))
    fails = F.array(*(pick("kept", 0) - pick("kept", b) for b in bit))
    unique = F.array(*(pick("kept", full ^ b) - pick("kept", full) for b in bit))
    own = indexed(rows, len(filters)).select("part", *COUNTS, shapley.alias("shapley"), fails.alias("fails"), unique.alias("unique"))
    each = own.select("*", F.inline(steps))
    after = F.col("b").bitwiseOR(F.call_function("shiftleft", F.lit(1), F.col("f")))
    lost = lambda c: pick(c, F.col("b")) - pick(c, after)
    return each.select(
        "part", "filter_order", "step", pick("kept", after).alias("kept"), lost("kept").alias("removed"), (F.get("fails", F.col("f")) - lost("kept")).alias("redundant"),
        F.get("unique", F.col("f")).alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("shapley", F.col("f")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    short_batches(docs.sparkSession)
    return audit(failures(docs, labels, part, id_col, text))
