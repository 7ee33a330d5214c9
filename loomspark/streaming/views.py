"""The event log as a stream: daily KPIs with exact users, new items, views that count. The batch forms are in operators.engagement."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, schema: str = EVENT, files_per_batch: int | None = None) -> DataFrame:
    """An append-only folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def counts_of_days(events: DataFrame, day: str, kinds: dict[str, str], key: str = "event_id", kind: str = "event_type") -> DataFrame:
    """Events per day, each event once however often and late it comes. State: the keys of all events, and a row per day."""
    counts = [F.count_if(F.col(kind) == v).alias(k) for k, v in kinds.items()]
    return events.dropDuplicates([key]).groupBy(day).agg(F.count(F.lit(1)).alias("n_events"), *counts)


def users_of_days(events: DataFrame, day: str, user: str) -> DataFrame:
    """Distinct users per day, exactly: a first step lets each user of a day pass once, a second one counts them. State: the
    pairs of day and user, and a row per day; nothing is forgotten, so late events count, and count once."""
    return events.where(F.col(user).isNotNull()).select(day, user).dropDuplicates([day, user]).groupBy(day).agg(F.count(F.lit(1)).alias("active_users"))


def new_items(items: DataFrame, key: str, ts: str | None = None, remember: str | None = None) -> DataFrame:
    """Items whose key was not seen before; what has been seen stays seen, unless `remember` bounds how long (by `ts`)."""
    if remember is None:
        return items.dropDuplicates([key])
    return items.withWatermark(ts, remember).dropDuplicatesWithinWatermark([key])


def spaced_views(views: DataFrame, seconds: int = 300) -> DataFrame:
    """Views (user_id, item, ts) that count: `seconds` at least after the pair's last one that did. State is one time a pair.

    Within a micro-batch a pair's views are taken in order of time; a pair that stays silent for twice the gap is forgotten.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        kept = []
        for ts in sorted(t for f in frames for t in f["ts"]):
            at = int(ts.timestamp())
            if last is None or at - last >= seconds:
                kept.append(ts)
                last = at
        state.update((last,))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), last * 1000) + 2000 * seconds)
        if kept:
            yield pd.DataFrame({"user_id": [key[0]] * len(kept), "item": [key[1]] * len(kept), "ts": kept})

    keyed = views.withWatermark("ts", f"{seconds} seconds").groupBy("user_id", "item")
    return keyed.applyInPandasWithState(step, "user_id long, item int, ts timestamp", "last long", "append", GroupStateTimeout.EventTimeTimeout)


def write_mart(stream: DataFrame, path: str, checkpoint: str, day: str = "day"):
    """Each micro-batch replaces its days in a mart partitioned by day."""
    from ..operators.writes import overwrite_days

    def put(batch: DataFrame, _: int) -> None:
        overwrite_days(batch, path, day)

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()
