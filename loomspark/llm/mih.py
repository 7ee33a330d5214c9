"""Exact top-k by Hamming distance with incremental multi-index hashing.

Codes are the signs of vectors. Rows of one code are one entry with its k + 1 smallest ids, so a vector that many rows
share costs no more than any other. Entries are dealt into shards, each to one place; queries stream past every shard. In a
shard, codes are indexed by their segments, and a query's segment radii grow one segment at a time until the k-th verified
distance lies within what is covered: after radius t in the first j + 1 of m segments and t - 1 in the rest, every code
within t * m + j bits has been seen. Whether a code has been seen before follows from its own distances per segment, so no
table of pairs is kept.

Codes are as wide as the longest vector needs, in words of 64 bits; segments do not cross words.

Cases: null ids, and vectors that are null or hold nulls, are neither queries nor neighbours; dimensions beyond a vector's
length count as not positive; a query never finds its own row, ties go to the smaller id, and where there are fewer than k
other rows the query has that many; an empty table gives none. Rows that repeat an id are one entry if their code is one.
Other columns are not read, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WORD, K = 64, 10
#: Shards at least, and codes of a shard: with 64 bits its index takes some 150 MB.
SHARDS, SHARD_CODES = 24, 1 << 21
#: Queries that are worked on at once in a shard.
AT_ONCE = 256


def words_for(vectors: DataFrame, vector: str = "embedding") -> int:
    """Words of 64 bits that the codes of these vectors need."""
    longest = vectors.agg(F.max(F.size(vector))).first()[0]
    return max(1, -(-(longest or 0) // WORD))


def codes(vectors: DataFrame, words: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, code): bit d is set where component d is positive; a code is its words as bytes, the lowest first."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(1).to_pylist()
            bits = np.zeros((len(rows), words * WORD), bool)
            good = [r is not None and None not in r for r in rows]
            for i, r in enumerate(rows):
                if good[i]:
                    bits[i, : len(r)] = np.asarray(r) > 0
            packed = np.packbits(bits, axis=1, bitorder="little")
            out = [row.tobytes() if ok else None for row, ok in zip(packed, good, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=[id_col, "code"])

    found = vectors.select(id_col, vector).mapInArrow(run, f"`{id_col}` {kind}, code binary")
    return found.where(F.col("code").isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), "code")


def as_words(column: list[bytes]) -> np.ndarray:
    """Codes as rows of 64-bit words."""
    return np.frombuffer(b"".join(column), "<u8").reshape(len(column), -1)


class Index:
    """Codes by the values of their segments."""

    def __init__(self, found: np.ndarray):
        self.codes = found
        self.bits = found.shape[1] * WORD
        width = min(16, max(8, int(np.log2(max(2, len(found))))))
        cuts = np.linspace(0, WORD, -(-WORD // width) + 1).astype(int).tolist()
        self.segments = []
        for word in range(found.shape[1]):
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                value = self.values(found, word, lo, hi)
                start = np.r_[0, np.cumsum(np.bincount(value, minlength=1 << (hi - lo)))]
                self.segments.append((word, lo, hi, start, np.argsort(value, kind="stable").astype(np.int32)))
        self.m = len(self.segments)

    @staticmethod
    def values(x: np.ndarray, word: int, lo: int, hi: int) -> np.ndarray:
        return ((x[:, word] >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)

    def nearest(self, queries: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance) of all codes as near as the k-th nearest row; a code counts as `weights` rows."""
        out = []
        for at in range(0, len(queries), AT_ONCE):
            q, c, d = self.block(queries[at : at + AT_ONCE], weights, k)
            out.append((q + at, c, d))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def fresh(self, x: np.ndarray, at: int, radius: int) -> np.ndarray:
        """Whether codes (x: their differences to their queries) that match in segment `at` within `radius` were met nowhere
        before: the segments before it are farther, those behind it are not nearer."""
        new = np.ones(len(x), bool)
        for j, (word, lo, hi, *_) in enumerate(self.segments):
            if j != at:
                far = np.bitwise_count(self.values(x, word, lo, hi))
                new &= (far > radius) if j < at else (far >= radius)
        return new

    def block(self, queries: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(queries)
        count = np.zeros((n, self.bits + 1), np.int64)
        best = np.full(n, self.bits)  # the distance of the k-th row so far
        open_ = np.arange(n)
        every = int(weights.sum())
        want = min(k, every)
        found = []
        for radius in range(WORD + 1):
            for j, (word, lo, hi, start, order) in enumerate(self.segments):
                if not len(open_):
                    break
                if radius > hi - lo:
                    continue
                masks = np.array([sum(1 << b for b in x) for x in combinations(range(hi - lo), radius)], np.int64)
                own = self.values(queries[open_], word, lo, hi)
                for part in range(0, len(masks), 1024):
                    probe = own[:, None] ^ masks[None, part : part + 1024]
                    first, many = start[probe], start[probe + 1] - start[probe]
                    who, mask = np.nonzero(many)
                    many, first = many[who, mask], first[who, mask]
                    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    code = order[np.repeat(first, many) + within]
                    q = open_[np.repeat(who, many)]
                    x = queries[q] ^ self.codes[code]
                    d = np.bitwise_count(x).sum(1, dtype=np.int64)
                    new = self.fresh(x, j, radius)
                    q, code, d = q[new], code[new], d[new]
                    np.add.at(count, (q, d), weights[code])
                    near = d <= best[q]
                    found.append((q[near], code[near], d[near]))
                reach = np.cumsum(count[open_], axis=1)
                enough = reach >= want
                best[open_] = np.where(enough.any(1), enough.argmax(1), self.bits)
                covered = radius * self.m + j
                open_ = open_[~((enough.any(1) & (best[open_] <= covered)) | (reach[:, -1] == every))]
            if not len(open_):
                break
        q, c, d = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ((),) * 3))
        keep = d <= best[q]
        return q[keep], c[keep], d[keep]


class Shard:
    """Entries of a shard as they come in, and their index once a query asks."""

    def __init__(self) -> None:
        self.codes: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.many: list[np.ndarray] = []
        self.index: Index | None = None

    def add(self, codes_: np.ndarray, ids: pa.ListArray) -> None:
        self.codes.append(codes_)
        self.ids.append(ids.flatten().to_numpy(zero_copy_only=False))
        self.many.append(pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64))

    def nearest(self, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, distance, id): the k nearest rows for each query code."""
        if self.index is None:
            self.index = Index(np.concatenate(self.codes))
            self.flat, self.weights = np.concatenate(self.ids), np.concatenate(self.many)
            self.begin = np.cumsum(self.weights) - self.weights
        q, c, d = self.index.nearest(asked, self.weights, k)
        many = self.weights[c]
        rows = np.repeat(np.arange(len(q)), many)
        ids = self.flat[np.repeat(self.begin[c], many) + np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)]
        q, d = q[rows], d[rows]
        order = np.lexsort((ids, d, q))
        q, d, ids = q[order], d[order], ids[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
        return q[keep], d[keep], ids[keep]


def stream(k: int):
    """Works on rows (shard, asks, code, ids), a shard's entries before the queries that ask it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, Shard()
        for batch in batches:
            if not batch.num_rows:
                continue
            number, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(number)], strict=True):
                part = batch.slice(lo, hi - lo)
                if number[lo] != at:
                    at, shard = number[lo], Shard()
                code = part.column(2).to_pylist()
                if not asks[lo]:
                    shard.add(as_words(code), part.column(3))
                elif shard.codes:
                    q, d, ids = shard.nearest(as_words(code), k)
                    yield pa.RecordBatch.from_arrays([pa.array(code, pa.binary()).take(pa.array(q)), pa.array(d, pa.int32()), pa.array(ids, pa.int64())], names=["query", "distance", "id"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, neighbour_id, distance): for each row of `queries`, which are rows of `vectors`, its k nearest others."""
    words = words_for(vectors, vector)
    coded = materialise(codes(vectors, words, id_col, vector), "codes")
    asked = codes(queries, words, id_col, vector).distinct()
    first = Window.partitionBy("code").orderBy("id")
    least = coded.distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    entries = materialise(least.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    shards = max(SHARDS, -(-entries.count() // SHARD_CODES))
    asked = materialise(asked, "queries")
    shard = F.pmod(F.xxhash64("code"), F.lit(shards)).cast("int").alias("shard")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    held = entries.select(shard, F.lit(False).alias("asks"), "code", F.col("ids").cast("array<bigint>").alias("ids"))
    asking = asked.select("code").distinct().select(every, F.lit(True).alias("asks"), "code", F.lit(None).cast("array<bigint>").alias("ids"))
    # a given number of tasks is not coalesced: a shard is work, not bytes
    dealt = held.unionByName(asking).repartition(shards, "shard").sortWithinPartitions("shard", "asks")
    near = dealt.mapInArrow(stream(k + 1), "query binary, distance int, id bigint")
    best = Window.partitionBy("query").orderBy("distance", "id")
    merged = materialise(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place"), "nearest")
    pairs = asked.select(F.col("id").alias("query_id"), F.col("code").alias("query")).join(merged, "query").where("id != query_id")
    own = Window.partitionBy("query_id").orderBy("distance", "id")
    ranked = pairs.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("neighbour_id"), "distance")
