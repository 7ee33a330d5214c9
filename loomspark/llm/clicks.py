"""Click deduplication that expires: repeats of a click within a span of hours are counted, not kept, and a window closes when
event time has passed it.

`deduplicate` plays batches of rows, a folder each, through a stateful streaming query (transformWithStateInPandas on RocksDB),
started anew for each batch on one checkpoint. Per click there is a window at most: its opener (hour and digest), how many
repeats it had, how many of them differ from the opener, and the sum of their checksums. Rows of a batch are folded in the
order of (click, hour, digest). Late rows are Spark's to drop: the watermark is the largest hour so far less LATE_HOURS and a
millisecond, so hours before it go and the hour itself stays. A window closes by an event-time timer half an hour after its
last hour, between two whole hours, so that the watermark decides the same whether or not it includes its own instant; timers fire
in the batch without data that Spark runs when the watermark has moved. After the last batch a sentinel row far in the future
closes all that is open.

State and timers are held per bucket of clicks, not per click: a call of the processor costs about a millisecond in Python
(a DataFrame, the key and half a dozen messages to the state store), which for millions of clicks, most with a row or two,
would be nearly all of the time. A bucket is some ten thousand rows; its windows are one packed value and its timer is
that of the window that ends first; rows fold by click in numpy. The number of buckets follows the number of rows.

A click that a third of all rows have: rows of its batch and hour whose digest no window of it can have (a window's digest is
the least of its hour in some batch) only add to counters, so they are added up before the stream sees them. What is left of
a click in a batch is some rows an hour, however many there were (`thinned`).

Cases: rows without a click id or an hour have no window; rows alike are repeats of each other; an hour before the window's own
is a repeat; an empty batch does nothing; no rows give no windows; other columns are not read, so no name clashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .common import materialise, shared_dir, store_of

BATCHES = 12
SPAN_HOURS = 72
LATE_HOURS = 48
HOUR_MS = 3_600_000
#: Rows of a bucket over all batches, buckets of a state store, and rows of a click from which on it is thinned.
BUCKET_ROWS, STORE_BUCKETS = 40_000, 8
BUSY_ROWS = 100_000

WINDOW = np.dtype([("click", "<i8"), ("start", "<i8"), ("digest", "V32"), ("repeats", "<i8"), ("conflicts", "<i8"), ("crc", "<i8")])
ROWS = "bucket bigint, click_id bigint, hour bigint, digest binary, n bigint, crc bigint, event_time timestamp"
CLOSED = "click_id bigint, start_hour bigint, n_repeats bigint, n_conflicts bigint, conflict_crc bigint, digest binary"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A start has a batch or two, so stores are closed as soon as they have committed: each open one holds a folder of megabytes,
#: and those of earlier starts would stay until maintenance comes round.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "true",
}


def fold(open_windows: np.ndarray, click: np.ndarray, hour: np.ndarray, digest: np.ndarray, opens: np.ndarray, n: np.ndarray, crc: np.ndarray, span: int = SPAN_HOURS) -> tuple[np.ndarray, np.ndarray]:
    """(windows that these rows close, windows open after them). `open_windows` has a window a click at most, sorted by click.

    A row stands for `n` rows alike, whose checksums come to `crc`. Rows are taken by click, hour and digest; rows that open
    nothing (`opens` false) stand last in their hour, where there is always one that does. All clicks go ahead at once, a
    window of each a round.
    """
    words = np.frombuffer(digest.tobytes(), ">u8").reshape(-1, 4)
    order = np.lexsort((words[:, 3], words[:, 2], words[:, 1], words[:, 0], ~opens, hour, click))
    click, hour, digest, n, crc = click[order], hour[order], digest[order], n[order], crc[order]
    keys, first = np.unique(click, return_index=True)
    end = np.append(first[1:], len(click))
    # hours as places in one ascending row: (rank of the click, hour)
    low, wide = hour.min(), int(hour.max() - hour.min()) + 2
    line = np.repeat(np.arange(len(keys)), end - first) * wide + (hour - low)
    totals = [np.append(0, np.cumsum(x)) for x in (n, crc)]

    held = np.searchsorted(open_windows["click"], keys)
    found = np.zeros(len(keys), bool)
    inside = held < len(open_windows)
    found[inside] = open_windows["click"][held[inside]] == keys[inside]
    now = np.zeros(len(keys), WINDOW)
    now[found] = open_windows[held[found]]
    rest = np.delete(open_windows, held[found])

    closed, at, live = [], first.copy(), found.copy()
    todo = np.arange(len(keys))
    while len(todo):
        fresh = todo[~live[todo]]
        opener = at[fresh]
        now["click"][fresh], now["start"][fresh], now["digest"][fresh] = keys[fresh], hour[opener], digest[opener]
        for c in ("repeats", "conflicts", "crc"):
            now[c][fresh] = 0
        # the opener is one of n rows alike: the others repeat it
        now["repeats"][fresh] -= 1
        live[fresh] = True
        last = np.clip(now["start"][todo] + span - low, -1, wide - 2)
        to = np.searchsorted(line, todo * wide + last, side="right")
        to = np.maximum(np.minimum(to, end[todo]), at[todo])
        here = at[todo]
        all_n, all_crc = totals[0][to] - totals[0][here], totals[1][to] - totals[1][here]
        owner = np.repeat(np.arange(len(todo)), to - here)
        rows = np.arange(len(owner)) - np.repeat(np.cumsum(to - here) - (to - here), to - here) + np.repeat(here, to - here)
        same = digest[rows] == now["digest"][todo][owner]
        same_n = np.bincount(owner[same], n[rows][same], len(todo)).astype(np.int64)
        same_crc = np.zeros(len(todo), np.int64)
        np.add.at(same_crc, owner[same], crc[rows][same])
        now["repeats"][todo] += all_n
        now["conflicts"][todo] += all_n - same_n
        now["crc"][todo] += all_crc - same_crc
        at[todo] = to
        todo = todo[to < end[todo]]
        closed.append(now[todo].copy())
        live[todo] = False
    after = np.concatenate([rest, now])
    return np.concatenate([*closed, np.zeros(0, WINDOW)]), after[np.argsort(after["click"], kind="stable")]


def shown(windows: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {"click_id": windows["click"], "start_hour": windows["start"], "n_repeats": windows["repeats"], "n_conflicts": windows["conflicts"], "conflict_crc": windows["crc"], "digest": [bytes(x) for x in windows["digest"]]}
    )


class Windows(StatefulProcessor):
    """The open windows of a bucket of clicks, packed in one value, and a timer for the one that ends first."""

    def __init__(self, span: int = SPAN_HOURS):
        self.span = span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getValueState("windows", "packed binary")

    def ends(self, windows: np.ndarray) -> np.ndarray:
        return (windows["start"] + self.span) * HOUR_MS + HOUR_MS // 2

    def held(self) -> np.ndarray:
        found = self.windows.get()
        return np.zeros(0, WINDOW) if found is None else np.frombuffer(bytes(found[0]), WINDOW)

    def keep(self, before: np.ndarray, after: np.ndarray, fired: bool = False) -> None:
        """Write the windows, and move the timer if another one ends first now."""
        old = int(self.ends(before).min()) if len(before) and not fired else None
        new = int(self.ends(after).min()) if len(after) else None
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            if new is not None:
                self.handle.registerTimer(new)
        if len(after):
            self.windows.update((after.tobytes(),))
        else:
            self.windows.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        parts = [self.arrays(x) for x in rows]
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        if len(columns[0]):
            before = self.held()
            closed, after = fold(before, *columns, span=self.span)
            self.keep(before, after)
            if len(closed):
                yield shown(closed)

    @staticmethod
    def arrays(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
        rows = rows[rows["n"] > 0]  # the sentinel counts for nothing
        opens = rows["digest"].notna().to_numpy(bool)
        digest = np.frombuffer(b"".join(x if ok else bytes(32) for x, ok in zip(rows["digest"], opens, strict=True)), "V32")
        return *(rows[c].to_numpy(np.int64) for c in ("click_id", "hour")), digest, opens, *(rows[c].to_numpy(np.int64) for c in ("n", "crc"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        before = self.held()
        over = self.ends(before) <= timerValues.getCurrentWatermarkInMs()
        self.keep(before, before[~over], fired=True)
        if over.any():
            yield shown(before[over])

    def close(self) -> None:
        pass


def thinned(rows: DataFrame, busy: DataFrame) -> DataFrame:
    """(batch, click_id, hour, digest, n, crc) of rows (batch, click_id, hour, digest, crc) of clicks with very many of them.

    A window's digest is the least of its hour in some batch. Rows with such a digest stay as they are, once each with their
    number; all others of an hour are one row without a digest, with their number and mean checksum kept as a sum of its own.
    """
    own = rows.join(busy, "click_id", "left_semi").groupBy("batch", "click_id", "hour", "digest", "crc").agg(F.count(F.lit(1)).alias("n"))
    own = materialise(own, "busy")
    least = own.groupBy("batch", "click_id", "hour").agg(F.min("digest").alias("digest")).select("click_id", "digest").distinct()
    marked = own.join(least.withColumn("_opens", F.lit(True)), ["click_id", "digest"], "left")
    digest = F.when(F.col("_opens"), F.col("digest"))
    merged = marked.groupBy("batch", "click_id", "hour", digest.alias("digest")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("crc")).alias("total"))
    return merged.select("batch", "click_id", "hour", "digest", "n", "total")


def cut(rows: DataFrame, path: str, buckets: int) -> None:
    """Write rows (batch, click_id, hour, digest, crc) as files of the stream's rows, a folder for each batch."""
    busy = materialise(rows.groupBy("click_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= BUSY_ROWS).select("click_id"), "busy-clicks")
    plain = rows.withColumns({"n": F.lit(1).cast("bigint"), "total": F.col("crc")})
    if not busy.isEmpty():
        plain = plain.join(busy, "click_id", "left_anti").select("batch", "click_id", "hour", "digest", "n", "total").unionByName(thinned(rows, busy))
    made = plain.select(
        "batch", F.pmod(F.xxhash64("click_id"), F.lit(buckets)).alias("bucket"), "click_id", "hour", "digest", "n", F.col("total").alias("crc"), F.timestamp_seconds(F.col("hour") * 3600).alias("event_time")
    )
    made.write.partitionBy("batch").parquet(path)


def sentinel(spark: SparkSession, hour: int) -> DataFrame:
    """A row that only moves the watermark, past every window."""
    row = {"bucket": 0, "click_id": 0, "hour": hour, "digest": None, "n": 0, "crc": 0}
    one = spark.range(1).select(*(F.lit(v).alias(k) for k, v in row.items()), F.timestamp_seconds(F.lit(hour * 3600)).alias("event_time"))
    return one.select(*(F.expr(f"CAST({c.split()[0]} AS {c.split()[1]})").alias(c.split()[0]) for c in ROWS.split(", ")))


def deduplicate(rows: DataFrame, batches: int = BATCHES, span: int = SPAN_HOURS, late: int = LATE_HOURS) -> DataFrame:
    """(click_id, start_hour, closed_batch, n_repeats, n_conflicts, conflict_crc, digest) of every window of the rows
    (batch, click_id, hour, digest, crc), whose batches are fed in order."""
    spark = rows.sparkSession
    base = f"{shared_dir(spark)}/loomspark-clicks-{uuid.uuid4().hex}"
    store, at = store_of(spark, base)
    store.deleteOnExit(at)
    path = lambda *parts: store_of(spark, "/".join([base, *parts]))[1]
    n, newest = rows.agg(F.count(F.lit(1)), F.max("hour")).first()
    buckets = max(1, -(-n // BUCKET_ROWS))
    cut(rows, f"{base}/cut", buckets)
    store.mkdirs(path("in"))
    # every start opens all stores, so there are as many as the rows ask for, not one for each partition of a shuffle
    stores = min(max(1, buckets // STORE_BUCKETS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    settings = SETTINGS | {"spark.sql.streaming.internal.stateStore.partitions": str(stores)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for k in range(batches):
            last = k == batches - 1
            if store.exists(path("cut", f"batch={k}")):
                store.rename(path("cut", f"batch={k}"), path("in", f"{k:06d}"))
                play(spark, base, k, span, late)
            if last:
                sentinel(spark, (newest or 0) + span + late + 2).coalesce(1).write.parquet(f"{base}/in/{k:06d}-flush")
                play(spark, base, k, span, late)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(f"{CLOSED}, closed_batch bigint").parquet(f"{base}/out").select("click_id", "start_hour", "closed_batch", "n_repeats", "n_conflicts", "conflict_crc", "digest")


def play(spark: SparkSession, base: str, batch: int, span: int, late: int) -> None:
    """Start the query on its checkpoint, let it read what is new, and let its timers fire; what it closes is this batch's."""
    rows = spark.readStream.schema(ROWS).parquet(f"{base}/in/*").withWatermark("event_time", f"{late * HOUR_MS + 1} milliseconds")
    closed = rows.groupBy("bucket").transformWithStateInPandas(Windows(span), CLOSED, "append", "EventTime")
    tagged = closed.withColumn("closed_batch", F.lit(batch).cast("bigint"))
    query = tagged.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def whole_hours(ts: Column, kind: str) -> Column:
    """Whole UTC hours since 1970 of a timestamp; one without a zone is taken as UTC, whatever the session's zone."""
    return F.call_function("div", micros(ts, kind) - F.pmod(micros(ts, kind), F.lit(HOUR_MS * 1000)), F.lit(HOUR_MS * 1000))


def micros(ts: Column, kind: str) -> Column:
    """Microseconds since 1970 in UTC; a timestamp without a zone is taken as UTC, whatever the session's zone."""
    if kind != "timestamp_ntz":
        return F.unix_micros(ts)
    second = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    day = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return ((day * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60_000_000 + second


def copied(clicks: DataFrame) -> DataFrame:
    """(click_id, hour, c, and a row's fields) of the copies j = 0 to click_id % 3 of every click."""
    kinds = dict(clicks.dtypes)
    rows = clicks.where("click_id IS NOT NULL AND arrived_at IS NOT NULL")
    each = rows.select("*", F.explode(F.sequence(F.lit(0), F.pmod("click_id", F.lit(3)).cast("int"))).alias("j"))
    c = F.crc32(F.concat_ws(":", F.col("click_id").cast("string"), F.col("j").cast("string")).cast("binary"))
    keyed = each.select("click_id", "client_id", "kind", "value", "ts", "props", whole_hours(F.col("arrived_at"), kinds["arrived_at"]).alias("_hour"), "j", c.alias("c"))
    return keyed.withColumn("hour", F.col("_hour") + F.lit(6) * F.col("j") * F.pmod("c", F.lit(10)))


def batched(clicks: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(batch, click_id, hour, digest, crc) of the copies of clicks, shuffled in time by their checksums."""
    place = F.col("hour") + F.pmod(F.floor(F.col("c") / 10).cast("bigint"), F.lit(200))
    copies = copied(clicks)
    low, high = copies.agg(F.min(place), F.max(place)).first()
    batch = F.call_function("div", (place - F.lit(low or 0)) * batches, F.lit((high or 0) - (low or 0) + 1))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    fields = ["client_id", "kind", F.floor(F.col("value") * 100 + 0.5).cast("bigint"), micros(F.col("ts"), dict(clicks.dtypes)["ts"]), "props", F.pmod("c", F.lit(3))]
    digest = F.sha2(F.concat_ws("|", *(text(F.col(f) if isinstance(f, str) else f) for f in fields)).cast("binary"), 256)
    found = copies.select(batch.cast("int").alias("batch"), "click_id", "hour", digest.alias("_hex"))
    return found.select("batch", "click_id", "hour", F.unhex("_hex").alias("digest"), F.crc32(F.col("_hex").cast("binary")).alias("crc"))
