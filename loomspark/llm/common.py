"""What the operators of this subpackage share: reading tables, bounded Arrow batches, tables in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space that separates words and is stripped from line keys.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows of one Arrow batch, and bytes of text that are worked on at once.
BATCH_ROWS = 512
CHUNK_BYTES = 4 << 20


def short_batches(spark: SparkSession) -> None:
    """Keep Arrow batches short, because a text can be long. It is a setting of the session, read when a query is planned."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where the master is local and the setting unset
    is there one of our own; on a cluster a folder of this machine would be empty on all others, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="loomspark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage is cut, lost executors lose nothing. The table is
    read whenever a result is, so it stays until the driver ends, or until `release`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomspark-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    store, at = store_of(spark, path)
    store.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def store_of(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def release(table: DataFrame) -> None:
    """Delete a table of `materialise` that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        store, at = store_of(table.sparkSession, path)
        store.delete(at, True)


def remainder(doc_id: Column, of: int) -> Column:
    """crc32(doc_id as text) mod `of`; null for a null id."""
    return F.crc32(doc_id.cast("string")) % of


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; pure ASCII takes the byte-wise way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def identified(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc, body, text): the id, a hash of the text that tells rows of one id apart, the text with null as empty."""
    return docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).select("doc", F.xxhash64("text").alias("body"), "text")


def chunks(batch: pa.RecordBatch, text_at: int = 1, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts come to about `limit` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_pylist()
    start = total = 0
    for at, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(df: DataFrame, work: Callable[..., list], schema: str, *keep: str, text: str = "text", use: str | None = None) -> DataFrame:
    """Columns `keep` and what `work` gives for each list of texts (None for null), as columns in the order of `schema`.

    `use` names one of `keep` whose values `work` gets as well.
    """
    kept = len(keep)
    used = None if use is None else keep.index(use)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, kept):
                more = () if used is None else (part.column(used).to_pylist(),)
                made = work(part.column(kept).to_pylist(), *more)
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], *map(pa.array, made)], names=names)

    short_batches(df.sparkSession)
    out = T.StructType([*(df.schema[k] for k in keep), *T.StructType.fromDDL(schema).fields])
    names = out.fieldNames()
    return df.select(*(F.col(f"`{k}`") for k in (*keep, text))).mapInArrow(run, out)


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, as UTF-8: what bytes.split() gives."""
    return text.encode().split() if text else []
