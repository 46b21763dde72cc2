"""Watching running streams: silent feeds by processing-time timers, and the queries' own progress as offset snapshots."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

ALERT = "symbol string, event string, at timestamp, last_tick timestamp, silent_seconds double"


class FeedWatch(StatefulProcessor):
    """One alert per silence of a feed, while it lasts, and one when the feed speaks again."""

    def __init__(self, limit_seconds: float):
        self.limit_ms = int(limit_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at_ms bigint, last_us bigint, alerted boolean")

    def _row(self, key, event: str, now_ms: int, since_ms: int, last_us: int) -> pd.DataFrame:
        times = pd.to_datetime([now_ms * 1000, last_us], unit="us")
        return pd.DataFrame({"symbol": [key[0]], "event": [event], "at": times[:1], "last_tick": times[1:], "silent_seconds": [(now_ms - since_ms) / 1000]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(frame["ts"].astype("datetime64[us]").astype("int64").max()) for frame in rows)
        now = timerValues.getCurrentProcessingTimeInMs()
        if self.seen.exists():
            at, last, alerted = self.seen.get()
            if alerted:
                yield self._row(key, "recovered", now, at, last)
            newest = max(newest, last)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        self.seen.update((now, newest, False))
        self.handle.registerTimer(now + self.limit_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        at, last, _ = self.seen.get()
        self.seen.update((at, last, True))
        yield self._row(key, "stale", now, at, last)

    def close(self) -> None:
        pass


def watch_feed(ticks: DataFrame, limit_seconds: float = 30.0) -> DataFrame:
    """``symbol, event, at, last_tick, silent_seconds``: ``stale`` once no tick of a symbol has come for so long, ``recovered`` later.

    The clock is the processing time of the micro-batches, so a silence is reported without another tick: run it with a
    processing-time trigger.  A symbol is watched from its first tick on.
    """
    return ticks.select("symbol", ticks["ts"].cast("timestamp").alias("ts")).groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=FeedWatch(limit_seconds), outputStructType=ALERT, outputMode="Append", timeMode="ProcessingTime")


SNAPSHOT = "query_id string, query_name string, batch_id long, polled_at timestamp, topic string, partition int, consumer_offset long, log_end_offset long, rows long"


def offsets_by_partition(text: str | None) -> dict[tuple[str, int], int]:
    """``{(topic, partition): offset}`` of a source that counts by topic and partition; empty for any other."""
    try:
        found = json.loads(text or "")
    except ValueError:
        return {}
    if not isinstance(found, dict) or not all(isinstance(v, dict) for v in found.values()):
        return {}
    return {(topic, int(p)): int(at) for topic, partitions in found.items() for p, at in partitions.items()}


class ProgressSnapshots(StreamingQueryListener):
    """Appends the progress of a session's streams to a table of offset snapshots, which ``operators.slo`` reads.

    Sources with offsets by topic and partition give a row for each.  Others give one row per source: its topic is the source's
    description, its offset the rows consumed so far (a restarted query goes on from its last snapshot), and its end what
    ``log_ends`` says of that description, or the same number.
    """

    def __init__(self, spark: SparkSession, path: str, log_ends: Callable[[str], int] | None = None):
        self.spark, self.path, self.log_ends = spark, path, log_ends
        self.consumed: dict[tuple[str, str], int] = {}

    def _before(self, query: str, topic: str) -> int:
        if (query, topic) not in self.consumed:
            root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            known = 0
            if root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root):
                last = read_snapshots(self.spark, self.path).where((F.col("query_id") == query) & (F.col("topic") == topic))
                known = last.agg(F.max("consumer_offset")).first()[0] or 0
            self.consumed[query, topic] = known
        return self.consumed[query, topic]

    def rows_of(self, progress) -> list[tuple]:
        query = str(progress.id)
        head = (query, progress.name, progress.batchId, datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).replace(tzinfo=None))
        rows = []
        for source in progress.sources:
            done, ends = offsets_by_partition(source.endOffset), offsets_by_partition(source.latestOffset)
            if done:
                rows += [(*head, topic, p, at, max(at, ends.get((topic, p), at)), source.numInputRows) for (topic, p), at in done.items()]
                continue
            topic = source.description
            at = self._before(query, topic) + source.numInputRows
            self.consumed[query, topic] = at
            rows.append((*head, topic, 0, at, max(at, self.log_ends(topic)) if self.log_ends else at, source.numInputRows))
        return rows

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = self.rows_of(event.progress)
        if rows:
            self.spark.createDataFrame(rows, SNAPSHOT).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT).parquet(path)


def stream_offsets(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(end offsets, commits)`` as of each query's last snapshot, in the form that ``slo.consumer_lag`` takes; the group is the query."""
    last = snapshots.groupBy("query_id", "topic", "partition").agg(F.max_by(F.struct("consumer_offset", "log_end_offset"), F.struct("polled_at", "batch_id", "consumer_offset")).alias("x"))
    ends = last.groupBy("topic", "partition").agg(F.max("x.log_end_offset").alias("log_end_offset"))
    return ends, last.select(F.col("query_id").alias("consumer_group"), "topic", "partition", F.col("x.consumer_offset").alias("consumer_offset"))
