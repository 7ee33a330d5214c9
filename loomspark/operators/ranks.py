"""Places in one order over all rows, and sums up to them, without a task that sees all rows.

Rows are dealt out by range (Spark draws the splitters from a sample) and sorted within their partitions; a row's place is its
place there plus the rows of the partitions before. Only the counts per partition, as many as there are partitions, come to
the driver.

Rows that are alike in all columns of an order meet in one partition, so an order should tell rows apart as far as it can;
`placed` does so with the partition that a row comes from, `ranked` by counting equal keys before they are dealt out.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import written

#: monotonically_increasing_id() has the partition above these bits and the row's place in it below.
LOW_BITS = 33


def in_ranges(rows: DataFrame, order: list[Column], weight: Column | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Rows with _part and _nth (their partition in the order, their place in it from 0); (_part, _base) with the rows (or
    weights) before a partition; the total. The rows are written, so that a partition stays what it is."""
    at = F.monotonically_increasing_id()
    ranged = rows.withColumn("_from", F.spark_partition_id())
    # `_from` spreads rows that are alike; it is the same again when a lost task is run again
    ranged = ranged.repartitionByRange(*order, F.col("_from")).sortWithinPartitions(*order, "_from").drop("_from")
    placed = F.shiftright(at, LOW_BITS).cast("int").alias("_part"), at.bitwiseAND(F.lit((1 << LOW_BITS) - 1)).alias("_nth")
    kept = written(ranged.select("*", *placed))
    sums = dict(kept.groupBy("_part").agg(F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")).collect())
    counts = [sums.get(i, 0) for i in range(max(sums, default=0) + 1)]
    before = [0, *accumulate(counts)]
    base = rows.sparkSession.range(1).select(F.posexplode(F.lit(before[:-1])).alias("_part", "_base"))
    return kept, base, before[-1]


def placed(rows: DataFrame, *order: Column, name: str = "place", first: int = 1) -> DataFrame:
    """Rows with `name`: their places in the order, gapless from `first`; places of rows alike in the order are arbitrary."""
    kept, base, _ = in_ranges(rows, list(order))
    out = kept.join(F.broadcast(base), "_part")  # a row for each partition
    return out.select(*rows.columns, (F.col("_base") + F.col("_nth") + F.lit(first)).cast("bigint").alias(name))


def same(left: list[str], right: list[str]) -> Column:
    """Keys that are equal, nulls too."""
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def placed_within(rows: DataFrame, by: list[str], *order: Column, name: str = "place", first: int = 1) -> DataFrame:
    """Rows with `name`: their places within their group, gapless from `first`.

    Rows are dealt out by (group, order), so a group of any size is as many partitions as it needs. What a row's place still
    lacks is the number of its group's rows in the partitions before: one row for each group and partition.
    """
    kept, _, _ = in_ranges(rows, [*map(F.col, by), *order])
    own = [f"_k{i}" for i in range(len(by))]
    runs = kept.groupBy(F.col("_part").alias("_p"), *(F.col(c).alias(k) for c, k in zip(by, own, strict=True))).agg(F.min("_nth").alias("_low"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*own).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_p", *own, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"))
    out = kept.join(runs, (F.col("_part") == F.col("_p")) & same(by, own))
    return out.select(*rows.columns, (F.col("_nth") + F.col("_shift") + F.lit(first)).cast("bigint").alias(name))


def sums_before(rows: DataFrame, order: list[str], weight: str, name: str = "before") -> tuple[DataFrame, int]:
    """Rows with `name`, the sum of `weight` (whole numbers) over all rows before them in the order; and the sum over all rows."""
    kept, base, total = in_ranges(rows, [F.col(c) for c in order], F.col(weight))
    own = Window.partitionBy("_part").orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    out = kept.withColumn("_own", F.coalesce(F.sum(weight).over(own), F.lit(0))).join(F.broadcast(base), "_part")
    return out.select(*rows.columns, (F.col("_base") + F.col("_own")).cast("bigint").alias(name)), total


def ranked(rows: DataFrame, keys: list[str], name: str = "place", dense: bool = False) -> DataFrame:
    """Rows with `name`: the rank of their key from 1, the same for rows of one key; `dense` leaves no gaps.

    Equal keys are counted before they are dealt out, so a key that a third of all rows have is one row of that table. Rows
    with a null key rank first, as Spark sorts them.
    """
    each = rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.count(F.lit(1)).alias("_n"))
    own = [f"_k{i}" for i in range(len(keys))]
    if dense:
        ranks = placed(each, *map(F.col, own), name=name).drop("_n")
    else:
        before, _ = sums_before(each, own, "_n", name)
        ranks = before.withColumn(name, F.col(name) + 1).drop("_n")
    return rows.join(ranks, same(keys, own)).drop(*own)
