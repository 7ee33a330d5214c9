"""Packing by minimum bin slack: documents are cut into windows, and what remains of them fills windows as full as can be.

A document's ids are cut every `window` ids; the last pieces' lengths form a histogram of at most `window` counts, which is
all that reaches the driver. There a bitset subset-sum picks, again and again, the multiset of remaining lengths that
comes closest to the window, and uses it as often as the counts allow. Pieces then find their place by their rank among
the pieces of their length.

Cases: a null or empty text is the one closing id; a text of any length is cut, never shortened; repeated rows are packed
as often as they come; an empty table gives no pieces; ties in length are dealt out by hash. Rows with the same id are told
apart only by their ranks. Other columns are not read, so no name clashes.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, materialise, short_batches

WINDOW, END_ID = 2048, 1
#: Each length is ranked in this many groups at least, and in more where there are over GROUP_ROWS pieces to a group.
GROUPS, GROUP_ROWS, SALTS = 64, 200_000, 64


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """One for each Python worker."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def ranked(path: str, pattern: str):
    """The same vocabulary by its rank file and the faster library; their ids agree, special token included."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


def ids_of(texts: list, path: str, rank_path: str | None, pattern: str | None) -> list:
    if rank_path:
        enc = ranked(rank_path, pattern)
        out = []
        for t in texts:
            try:
                out.append(enc.encode(t or "", allowed_special="all"))
            except BaseException as e:  # its pattern engine gives up on long runs of blanks, with an error that is no Exception
                if type(e).__name__ != "PanicException":
                    raise
                out.append(tokenizer(path).encode(t or "", add_special_tokens=False).ids)
        return out
    return [x.ids for x in tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def pieces(docs: DataFrame, path: str, window: int = WINDOW, rank_path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, salt): every document's ids and the closing id, cut every `window` ids. The
    salt goes round within a task, so that rows that are alike in all else can be dealt out."""
    short_batches(docs.sparkSession)
    out = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, salt bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            for part in chunks(batch):
                row, start, length, crc, total = [], [], [], [], []
                for k, ids in enumerate(ids_of(part.column(1).to_pylist(), path, rank_path, pattern)):
                    raw = np.array([*ids, END_ID], "<u4").tobytes()
                    n = len(raw) // 4
                    for at in range(0, n, window):
                        piece = raw[4 * at : 4 * (at + window)]
                        row.append(k)
                        start.append(at)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                ids = part.column(0).take(pa.array(row, pa.int32()))
                salt = [(seen + k) % SALTS for k in range(len(row))]
                seen += len(row)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in (start, length, crc, total, salt))], names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "salt"])

    return docs.select(id_col, text).mapInArrow(run, out)


def fullest(counts: dict[int, int], window: int) -> list[int]:
    """Lengths, with repetition, whose sum is the largest that fits the window; the longest piece is always in.

    Bit s of a bitset says that sum s can be had. Lengths come in falling order; a length's count is split into powers of
    two. Walking the bitsets back tells how often each length is in.
    """
    first = max(counts)
    left = dict(counts)
    left[first] -= 1
    room = window - first
    mask, reach, trail = (1 << room + 1) - 1, 1, []
    for length in sorted(left, reverse=True):
        n, unit = min(left[length], room // length) if length <= room else 0, 1
        while n > 0:
            take = min(unit, n)
            trail.append((length, take, reach))
            reach |= reach << length * take & mask
            n, unit = n - take, unit * 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, [first]
    for length, take, before in reversed(trail):
        if not before >> total & 1:
            chosen += [length] * take
            total -= length * take
    return chosen


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, list[int]]]:
    """(first sequence, how many, lengths in order) until every piece has a place."""
    left, out, sequence = {k: n for k, n in histogram.items() if n}, [], 0
    while left:
        chosen = fullest(left, window)
        need: dict[int, int] = {}
        for x in chosen:
            need[x] = need.get(x, 0) + 1
        times = min(left[x] // n for x, n in need.items())
        out.append((sequence, times, chosen))
        sequence += times
        for x, n in need.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return out


class Places:
    """Where the r-th piece of a length goes. Size: at most a few thousand patterns, whatever the input."""

    def __init__(self, patterns: list[tuple[int, int, list[int]]], window: int = WINDOW):
        used: dict[int, int] = {}
        rows = []
        for first, times, lengths in patterns:
            offset, slots = 0, {}
            for x in lengths:
                slots.setdefault(x, []).append(offset)
                offset += x
            for x, offsets in slots.items():
                rows.append((x, used.get(x, 0), first, len(offsets), offsets))
                used[x] = used.get(x, 0) + times * len(offsets)
        rows.sort(key=lambda r: r[:2])
        self.shift = 44
        self.key = np.array([x << self.shift | start for x, start, *_ in rows], np.int64)
        self.begin, self.first, self.many = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
        self.at = np.cumsum([0, *(len(r[4]) for r in rows)])
        self.offsets = np.array([o for r in rows for o in r[4]], np.int64)

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, length << self.shift | rank, side="right") - 1
        nth = rank - self.begin[k]
        return self.first[k] + nth // self.many[k], self.offsets[self.at[k] + nth % self.many[k]]


def pack(docs: DataFrame, path: str, window: int = WINDOW, rank_path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): a row per piece."""
    cut = materialise(pieces(docs, path, window, rank_path, pattern, id_col, text), "pieces")
    groups = max(GROUPS, -(-cut.count() // GROUP_ROWS))
    group = F.pmod(F.xxhash64(id_col, "start", "ids_crc32", "salt"), F.lit(groups)).cast("int")
    by_group = cut.groupBy("length", group.alias("grp")).count()
    histogram = {r["length"]: r["n"] for r in by_group.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    places = Places(plan(histogram, window), window)
    before = F.sum("count").over(Window.partitionBy("length").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1))
    bases = by_group.select("length", "grp", F.coalesce(before, F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "grp").orderBy(id_col, "start", "ids_crc32")
    nth = cut.withColumn("grp", group).withColumn("nth", F.row_number().over(order) - 1)
    placed = nth.join(bases, ["length", "grp"]).select(id_col, "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth")).alias("rank"))
    kind = docs.schema[id_col].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sequence, offset = places(*(pc.cast(b.column(k), pa.int64()).to_numpy() for k in (2, 5)))
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(place, f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
