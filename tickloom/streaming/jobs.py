"""Stream sinks and jobs: checkpointed consumption, handlers with dead letters, two sinks per batch, scoring, silent feeds."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.operators.models import score_with_variant
from tickloom.sources.files import feature_messages
from tickloom.sources.versions import ModelVersions
from tickloom.sources.ticks import parse_ticks


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything that is there now, in as many micro-batches as the source's limits give, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_table(stream: DataFrame, path: str) -> DataStreamWriter:
    """Append rows to a snappy Parquet table (exactly once per checkpoint)."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "compression", "snappy")


def publish(stream: DataFrame, fmt: str = "kafka", **options: str) -> DataStreamWriter:
    """Publish feature rows as JSON messages."""
    return feature_messages(stream).writeStream.format(fmt).outputMode("append").options(**options)


def batch_folder(root: str, batch_id: int, batch: DataFrame | None = None) -> str:
    """Folder of one micro-batch; that of a running query also bears the query's id, which its checkpoint keeps.

    A repeated batch finds its own folder again, and a query with a new checkpoint never meets the folders of an old one.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") if batch is not None else None
    return f"{root}/query_id={query or 'none'}/batch_id={batch_id}"


def dual_sink(stream: DataFrame, table_path: str, topic_writer: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Send each computed row both to a table and to a topic.

    A repeated batch overwrites its own folder, so the table holds each row once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(batch_folder(table_path, batch_id, batch))
            topic_writer(feature_messages(batch), batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write)


def split_late(features: DataFrame, features_path: str, late_path: str) -> DataStreamWriter:
    """Rows of ``stream_tick_features(..., tag_late=True)`` into two tables: features, and late ticks as they came."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.where(~F.col("late")).drop("late").write.mode("overwrite").parquet(batch_folder(features_path, batch_id, batch))
            batch.where("late").select("symbol", "seq", "ts", "price", "bid", "ask").write.mode("overwrite").parquet(batch_folder(late_path, batch_id, batch))
        finally:
            batch.unpersist()

    return features.writeStream.foreachBatch(write)


def consume_with_checkpoint(messages: DataFrame, ticks_path: str, counters_path: str) -> DataStreamWriter:
    """At-least-once consumption: valid ticks and per-batch counters (processed, failed), keyed by batch.

    The counters are observed while the ticks are written: one pass over the messages, nothing held.  Pace with the source's limit
    (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``) and the trigger interval.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        parsed = parse_ticks(batch).observe(seen, F.count(F.lit(1)).alias("received"), F.count("reason").alias("failed"))
        parsed.where(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(batch_folder(ticks_path, batch_id, batch))
        counts = seen.get
        row = (counts["received"], counts["failed"], counts["received"] - counts["failed"])
        batch.sparkSession.createDataFrame([row], "received long, failed long, processed long").coalesce(1).write.mode("overwrite").parquet(
            batch_folder(counters_path, batch_id, batch))

    return messages.writeStream.foreachBatch(write)


#: A handler gets the messages of an Arrow batch and returns, for each, None or why it failed.
Handler = Callable[[pa.RecordBatch], Sequence[str | None]]


def judged(messages: DataFrame, handler: Handler) -> DataFrame:
    """``messages`` with ``reason``: what the handler says of each, NULL if it is content.

    A handler that raises does not stop anything: the batch is halved until the failing messages are alone, and these get the
    exception as their reason.
    """
    def verdicts(batch: pa.RecordBatch) -> list[str | None]:
        try:
            found = list(handler(batch))
            if len(found) != batch.num_rows:
                raise ValueError(f"the handler returned {len(found)} verdicts for {batch.num_rows} messages")
            return [None if x is None else str(x) for x in found]
        except Exception as error:  # noqa: BLE001  whatever a caller's handler raises
            if batch.num_rows == 1:
                return [f"{type(error).__name__}: {error}"]
            half = batch.num_rows // 2
            return verdicts(batch.slice(0, half)) + verdicts(batch.slice(half))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(verdicts(batch), pa.string())], names=[*batch.schema.names, "reason"])

    return messages.mapInArrow(judge, T.StructType([*messages.schema.fields, T.StructField("reason", T.StringType())]))


def consume_with_handler(messages: DataFrame, handler: Handler, handled_path: str, dead_letters_path: str) -> DataStreamWriter:
    """Hands every message to ``handler``; those that pass go to one table, the others with their reason to the dead letters.

    Both tables have a folder per batch that a repeated batch overwrites, so each message is in one of them once.  Columns such as
    topic, partition and offset travel along.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        found = judged(batch, handler).persist()
        try:
            found.where(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(batch_folder(handled_path, batch_id, batch))
            found.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(batch_folder(dead_letters_path, batch_id, batch))
        finally:
            found.unpersist()

    return messages.writeStream.foreachBatch(write)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters of all queries and batches: the messages' columns, ``reason``, ``query_id`` and ``batch_id``."""
    return spark.read.parquet(path)


def replay_dead_letters(spark: SparkSession, dead_letters_path: str, handler: Handler, handled_path: str, still_dead_path: str) -> None:
    """Hands the dead letters to ``handler`` once more: into the folder ``replay`` of one table, or of the other with the new reason.

    The dead letters stay as they are; a repeated replay overwrites its own folders.
    """
    letters = read_dead_letters(spark, dead_letters_path).drop("reason", "query_id", "batch_id")
    found = judged(letters, handler).persist()
    try:
        found.where(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(f"{handled_path}/query_id=replay/batch_id=0")
        found.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{still_dead_path}/query_id=replay/batch_id=0")
    finally:
        found.unpersist()


def paced(writer: DataStreamWriter, checkpoint: str, interval: str = "5 seconds") -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def stream_score(features: DataFrame, variant: str | None = "baseline", model=None) -> DataFrame:
    """Prediction records for a stream of feature rows."""
    return score_with_variant(features, variant, model)


def score_versions(features: DataFrame, versions: ModelVersions, path: str) -> DataStreamWriter:
    """Prediction records scored by the version in force when a micro-batch begins, stamped with it.

    Putting another version in force, or an old one again, takes effect with the next micro-batch; the query runs on.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        name, variant, model = versions.in_force(batch.sparkSession)
        scored = score_with_variant(batch, variant, model).withColumn("model_version", F.lit(name))
        scored.write.mode("overwrite").parquet(batch_folder(path, batch_id, batch))

    return features.writeStream.foreachBatch(write)


def feed_sessions(ticks: DataFrame, gap: str = "30 seconds", watermark: str = "1 minute") -> DataFrame:
    """Uninterrupted stretches of a feed: each stretch ends with a silence of at least ``gap``."""
    sessions = ticks.withWatermark("ts", watermark).groupBy("symbol", F.session_window("ts", gap)).agg(
        F.min("ts").alias("first_tick"), F.max("ts").alias("last_tick"), F.count(F.lit(1)).alias("ticks"))
    return sessions.drop("session_window")
