"""Sharding along a Hilbert curve: rows that are alike in several metadata columns lie in the same few shards.

Each dimension is quantised into 2**bits cells of about equal numbers of rows, whatever its type, and keeps its order. The
cells of a row are a point of a grid; a Hilbert curve visits every point of it, and points near on the curve are near in every
dimension. Rows are sorted by their place on the curve and cut into runs of equal length, one for each shard. A reader that
asks for a range of any one of the dimensions opens few shards (`manifest` has the least and largest value in each), where a
sort by one column would prune by that column alone.

Only DataFrame functions. Distinct values of a dimension are counted before they are dealt out by range; of them only the
2**bits least values of the cells come to the driver. The curve is a walk through a table of states (made from the rule, not
written down), folded over the bits. Rows are dealt out by range of (place on the curve, hash of the text, id), so a source that
a third of all rows have is many partitions, and only what `keep` names travels with them: the texts do not, unless asked for.

Law: `rows`, counts of the shards are at most one apart, exactly: row number r of n goes to shard r * shards DIV n.

Cases: a null in a dimension is in the lowest cell; a null text has no bytes and the checksum of none; a null id sorts first;
equal texts with equal metadata are next to each other on the curve; rows that are alike altogether are spread by where they
come from; an empty table gives no rows; fewer rows than shards leave shards empty; `keep` columns travel in a struct, so no
name clashes.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import placed, sums_before

DIMENSIONS = ("source", "lang", "n_chars")
BITS = 5


@cache
def states(dims: int) -> tuple[list[int], list[int]]:
    """The curve as a table: entry state * 2**dims + (one bit of each dimension) gives these bits' digit on the curve, and the
    next state. A state is the corner where a cell is entered and the direction of its walk; both change by the Gray code."""
    n, full = dims, (1 << dims) - 1
    turn = lambda x, k: ((x >> (k % n)) | (x << (n - k % n))) & full
    gray = lambda i: i ^ (i >> 1)
    back = {gray(i): i for i in range(full + 1)}
    ones = lambda i: (i ^ (i + 1)).bit_length() - 1
    entry = lambda w: 0 if w == 0 else gray(2 * ((w - 1) // 2))
    direction = lambda w: 0 if w == 0 else ones(w - 1 if w % 2 == 0 else w) % n
    seen, todo, digits, nexts = {(0, 0): 0}, [(0, 0)], [], []
    for e, d in todo:
        for bits in range(full + 1):
            w = back[turn(bits ^ e, d + 1)]
            then = (e ^ turn(entry(w), n - (d + 1) % n), (d + direction(w) + 1) % n)
            if then not in seen:
                seen[then] = len(seen)
                todo.append(then)
            digits.append(w)
            nexts.append(seen[then])
    return digits, nexts


def curve(cells: list[Column], bits: int) -> Column:
    """The place of a point on the curve through a grid of 2**bits cells a side."""
    dims = len(cells)
    digits, nexts = (F.lit(x) for x in states(dims))

    def step(acc: Column, level: Column) -> Column:
        bit = lambda c: F.call_function("shiftright", c, level).bitwiseAND(F.lit(1))
        at = acc["state"] * F.lit(1 << dims) + sum((bit(c) * F.lit(1 << i) for i, c in enumerate(cells)), F.lit(0))
        return F.struct(F.get(nexts, at).alias("state"), (acc["place"] * F.lit(1 << dims) + F.get(digits, at)).alias("place"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("bigint").alias("place"))
    return F.aggregate(F.lit(list(range(bits - 1, -1, -1))), start, step, lambda a: a["place"])


def cuts(rows: DataFrame, column: str, cells: int) -> list[tuple]:
    """(least value, cell) of the cells that have rows, in order, about as many rows in each: 2**bits rows at most."""
    counted = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    before, total = sums_before(counted, [column], "_n", "_before")
    cell = F.floor(F.col("_before") / F.lit(max(total, 1)) * F.lit(cells)).cast("int")
    return [tuple(r) for r in before.groupBy(cell.alias("cell")).agg(F.min(column).alias("least")).orderBy("cell").select("least", "cell").collect()]


def cell_of(value: Column, found: list[tuple]) -> Column:
    """The cell of a value: that of the last cut that is not above it; the lowest for null."""
    if not found:
        return F.lit(0)
    least, cells = F.array(*(F.lit(v) for v, _ in found)), F.lit([0, *(c for _, c in found)])
    return F.get(cells, F.coalesce(F.size(F.filter(least, lambda x: x <= value)), F.lit(0)))


def assign(docs: DataFrame, shards: int = 8, dims: tuple[str, ...] = DIMENSIONS, bits: int = BITS, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, place, shard, slot, and `row` with the columns of `keep`): every row's place on the curve, its
    shard, and its place there from 0. `size` is the text's bytes and one more."""
    points = docs.select(*(F.col(f"`{c}`").alias(f"_d{i}") for i, c in enumerate(dims)))
    found = [cuts(points, f"_d{i}", 1 << bits) for i in range(len(dims))]
    raw = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), raw.alias("_raw"), *(cell_of(F.col(f"`{c}`"), f).alias(f"_c{i}") for i, (c, f) in enumerate(zip(dims, found, strict=True))),
        *([F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")] if keep else []),
    )
    keyed = rows.select(
        "doc_id", (F.octet_length("_raw") + F.lit(1)).cast("bigint").alias("size"), F.crc32("_raw").alias("text_crc32"),
        curve([F.col(f"_c{i}") for i in range(len(dims))], bits).alias("place"), F.xxhash64("_raw").alias("_hash"), *(["row"] if keep else []),
    )
    ordered = placed(keyed, F.asc("place"), F.asc("_hash"), F.asc("doc_id"), name="_rank", first=0)
    total = ordered.select("_rank").agg(F.max("_rank")).first()[0]
    n, k = F.lit((total or 0) + 1), F.lit(shards)
    shard = F.call_function("div", F.col("_rank") * k, n).cast("int")
    first = F.call_function("div", F.col("shard") * n + k - 1, k)  # the least rank of a shard
    sharded = ordered.withColumn("shard", shard).withColumn("slot", (F.col("_rank") - first).cast("bigint"))
    return sharded.select("doc_id", "size", "text_crc32", "place", "shard", "slot", *(["row"] if keep else []))


def manifest(assigned: DataFrame, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """A row for each shard: rows, bytes, and the least and largest value of each dimension (of `row`, so `keep` has them)."""
    ends = [f(F.col(f"row.`{c}`")).alias(f"{n}_{c}") for c in dims for n, f in (("min", F.min), ("max", F.max))]
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("bytes"), *ends)


def write(docs: DataFrame, path: str, shards: int = 8, dims: tuple[str, ...] = DIMENSIONS, bits: int = BITS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole rows written as Parquet, a folder for each shard, in the curve's order; gives the manifest."""
    assigned = assign(docs, shards, dims, bits, id_col, text, tuple(docs.columns))
    # what is read back is in runs of the curve already: a task holds rows of one shard, or of two next to each other
    assigned.sortWithinPartitions("shard", "slot").select("row.*", F.col("shard").alias("_shard")).write.partitionBy("_shard").parquet(path)
    return manifest(assigned, dims)
