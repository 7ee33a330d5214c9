"""Playing a table through a streaming query: its rows cut into batches, fed in order, the query started anew for each.

Batches are written once, a folder each, beside the folder that the query watches, and moved into it one after the other. Each start
reads what is new (`availableNow`), keeps its state on one checkpoint, and ends; so every batch but the first runs after a
restart. All of it stands in a new folder under spark.checkpoint.dir.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import workspace

#: Stores are closed as soon as they have committed: a start has few batches, and open stores of earlier ones would stay.
STORES = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def played(rows: DataFrame, batch: str, start: Callable[[DataFrame, str], StreamingQuery]) -> str:
    """Feed rows in the order of their batch numbers to the query that `start` begins on a stream, given the folder for its
    checkpoint and output; gives that folder."""
    spark = rows.sparkSession
    base = workspace(spark)
    rows.write.partitionBy(batch).parquet(f"{base}/cut")
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path(f"{base}/in"))
    schema = rows.drop(batch).schema
    numbers = sorted(int(x.getPath().getName().split("=")[1]) for x in store.listStatus(path(f"{base}/cut")) if "=" in x.getPath().getName())
    before = {k: spark.conf.get(k, None) for k in STORES}
    for k, v in STORES.items():
        spark.conf.set(k, v)
    try:
        for n in numbers:
            store.rename(path(f"{base}/cut/{batch}={n}"), path(f"{base}/in/{n:08d}"))
            start(spark.readStream.schema(schema).parquet(f"{base}/in/*"), base).awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return base


def keep_versions(stream: DataFrame, base: str, name: str, mode: str = "update") -> StreamingQuery:
    """Write each micro-batch's rows as a version of its own; a batch that runs again writes its version again."""

    def put(rows: DataFrame, n: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/{name}/version={n:08d}")

    return stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/{name}-checkpoint").foreachBatch(put).trigger(availableNow=True).start()


def latest(spark: SparkSession, base: str, name: str, keys: list[str]) -> DataFrame:
    """Of each key the row of the last version that has it."""
    rows = spark.read.parquet(f"{base}/{name}")
    own = [c for c in rows.columns if c != "version"]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*own), "version").alias("_row"))
    return last.select("_row.*")
