"""Guarded apply: several tables change together or not at all, partition by partition.

A store is a folder of partitions that never change, and of manifests: a manifest is a small file that names, for each table
and partition, the folder that holds it, its number of rows and a digest. The last manifest is the state. An apply

1. stages the partitions that it brings, in a folder of its run, each table with a note of counts and digests when it is whole;
   a run that is started again with the same id takes over what it finds noted;
2. reads the staged rows back and holds them to the note, then asks its checks about the tables as they would be;
3. writes one new manifest. That is the only step that changes the state, and it is one rename, so a failure before it leaves
   everything as it was, whichever tables were staged by then. Partitions that are not brought keep their folders.

Rolling back is a manifest with an older content. Only manifests, a line for each partition, pass the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    """Tables under `root`: {name: (partition column, schema as DDL)}."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, tuple[str, str]]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def write_file(self, path: str, content: dict) -> None:
        """The whole file or none of it; an error if it is there already."""
        at, new = self.path(path), self.path(f"{path}.new")
        out = self.fs.create(new, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if self.fs.exists(at) or not self.fs.rename(new, at):
            raise FileExistsError(path)

    def read_file(self, path: str) -> dict | None:
        if not self.fs.exists(self.path(path)):
            return None
        return json.loads("\n".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect()))

    def versions(self) -> list[int]:
        at = self.path(f"{self.root}/manifests")
        names = [x.getPath().getName() for x in self.fs.listStatus(at)] if self.fs.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """{table: {partition: [folder, rows, digest]}} of a version, the last one unless given; nothing before the first."""
        known = self.versions()
        if not known:
            return {t: {} for t in self.tables}
        return self.read_file(f"{self.root}/manifests/{known[-1] if version is None else version:08d}.json")

    def table(self, name: str, manifest: dict | None = None) -> DataFrame:
        """The rows of a table, as the state or a manifest has it."""
        schema = self.tables[name][1]
        folders = [x[0] for x in (manifest or self.manifest())[name].values()]
        rows = self.spark.read.schema(schema)
        return rows.parquet(*(f"{self.root}/{f}" for f in folders)) if folders else self.spark.createDataFrame([], schema)

    def stage(self, run: str, name: str, rows: DataFrame) -> dict:
        """{partition: [folder, rows, digest]} of rows that replace the partitions they belong to. What a run with this id has
        staged and noted before is taken over."""
        base, column = f"staged/{run}/{name}", self.tables[name][0]
        noted = self.read_file(f"{self.root}/{base}.json")
        if noted is not None:
            return noted
        own = rows.select(*(c.split()[0] for c in self.tables[name][1].split(", ")))
        keyed = own.withColumn("_part", F.coalesce(F.col(column).cast("string"), F.lit("_none")))
        keyed.write.mode("overwrite").partitionBy("_part").parquet(f"{self.root}/{base}")
        sums = {r["_part"]: [r["n"], r["digest"]] for r in self.digests(keyed).collect()}
        folders = {x.getPath().getName() for x in self.fs.listStatus(self.path(f"{self.root}/{base}"))}
        escaped = {self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(p): p for p in sums}
        found = {escaped[f.removeprefix("_part=")]: f for f in folders if f.startswith("_part=")}
        note = {p: [f"{base}/{f}", *sums[p]] for p, f in found.items()}
        self.write_file(f"{self.root}/{base}.json", note)
        return note

    @staticmethod
    def digests(keyed: DataFrame) -> DataFrame:
        """Rows and an order-free digest of each partition."""
        own = [F.col(f"`{c}`") for c in keyed.columns if c != "_part"]
        return keyed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*own)).cast("string").alias("digest"))

    def verify(self, name: str, note: dict) -> None:
        """Staged partitions hold what was noted."""
        column = self.tables[name][0]
        rows = self.table(name, {name: note}).withColumn("_part", F.coalesce(F.col(column).cast("string"), F.lit("_none")))
        found = {r["_part"]: [r["n"], r["digest"]] for r in self.digests(rows).collect()}
        if found != {p: x[1:] for p, x in note.items()}:
            raise ValueError(f"what is staged for {name} is not what was written")

    def apply(self, run: str, brought: dict[str, DataFrame], checks: list[Callable[[dict[str, DataFrame]], str | None]] = ()) -> int:
        """Bring partitions of several tables into the state, all or none; gives the new version. A check gets the tables as
        they would be and gives what is wrong, or None."""
        state = self.manifest()
        fresh = {t: dict(x) for t, x in state.items()}
        for name, rows in brought.items():
            note = self.stage(run, name, rows)
            self.verify(name, note)
            fresh[name] |= note
        wrong = [w for check in checks if (w := check({t: self.table(t, fresh) for t in self.tables}))]
        if wrong:
            raise ValueError("; ".join(wrong))
        return self.publish(fresh)

    def publish(self, manifest: dict) -> int:
        version = (self.versions() or [0])[-1] + 1
        self.write_file(f"{self.root}/manifests/{version:08d}.json", manifest)
        return version

    def roll_back(self, version: int) -> int:
        """The state of an older version, as a new one."""
        return self.publish(self.manifest(version))
