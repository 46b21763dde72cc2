"""Raw ticker messages: read, parse, filter, replay.  The same parser serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tickloom.operators.ordered import numbered, split_ordered
from tickloom.schemas import RAW_TICK

_WITH_CORRUPT = T.StructType([*RAW_TICK.fields, T.StructField("_corrupt", T.StringType())])
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"
_ISO_TIME = r"^\d{4}-\d{2}-\d{2}"


def read_tick_stream(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Unbounded raw messages as ``value`` strings.  Kafka starts at the latest offset unless told otherwise;
    ``fmt="text"`` reads files of JSON lines with the same result."""
    if fmt == "kafka":
        options = {"startingOffsets": "latest", **options}
    return spark.readStream.format(fmt).options(**options).load().select(F.col("value").cast("string").alias("value"))


def read_ticks(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Bounded raw messages as ``value`` strings, Kafka topics from the earliest offset."""
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", **options}
    return spark.read.format(fmt).options(**options).load().select(F.col("value").cast("string").alias("value"))


def read_raw_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited ticker messages with their declared schema (never inferred)."""
    return spark.read.schema(RAW_TICK).json(path)


def decoded(messages: DataFrame) -> DataFrame:
    """Add the message fields; ``_corrupt`` holds text that is not a JSON object."""
    tick = F.from_json("value", _WITH_CORRUPT, {"columnNameOfCorruptRecord": "_corrupt"})
    return messages.withColumn("_tick", tick).select(*messages.columns, "_tick.*")


def message_fields(messages: DataFrame, more: dict[str, str] | None = None) -> DataFrame:
    """product, price, time and volume of each message, 'N/A' where absent; ``more``: further fields and their names."""
    fields = {"product_id": "product_id", "price": "price", "time": "time", "volume_24h": "volume_24h"}
    fields |= {name: field for field, name in (more or {}).items()}
    return decoded(messages).where(F.col("_corrupt").isNull()).select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("N/A")).alias(n) for n, c in fields.items())
    )


def ticker_filter(messages: DataFrame) -> DataFrame:
    """Ticker messages only, stamped with the time of ingestion."""
    return (
        decoded(messages).where(F.col("_corrupt").isNull() & (F.col("type") == "ticker"))
        .drop("_corrupt").withColumn("ingestion_timestamp", F.current_timestamp())
    )


def undecodable(messages: DataFrame) -> DataFrame:
    return decoded(messages).where(F.col("_corrupt").isNotNull()).select(*messages.columns)


def number(text: Column) -> Column:
    """Text to double, NULL if it is not a number ('nan' and 'inf' are)."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def parse_ticks(messages: DataFrame) -> DataFrame:
    """Typed ticks with ``reason`` = NULL for valid rows, else the first fault.

    A quote that is absent takes the price; one that is present but null or not a number rejects the row.
    """
    price = number(F.col("price"))
    ts = F.when(F.col("time").rlike(_ISO_TIME), F.try_to_timestamp("time"))

    def quote(c: str) -> tuple[Column, Column]:
        given = F.col(c).isNotNull()
        explicit_null = F.col(c).isNull() & F.coalesce(
            F.array_contains(F.json_object_keys("value"), c), F.lit(False)
        )
        value = F.when(given, number(F.col(c))).otherwise(price)
        return value, explicit_null | (given & number(F.col(c)).isNull())

    bid, bad_bid = quote("best_bid")
    ask, bad_ask = quote("best_ask")
    reason = (
        F.when(F.col("_corrupt").isNotNull(), "invalid_json").when(price.isNull(), "price").when(ts.isNull(), "time")
        .when(bad_bid, "best_bid").when(bad_ask, "best_ask")
    )
    kept = [c for c in messages.columns if c != "value"]
    return decoded(messages).select(
        *kept, F.col("product_id").alias("symbol"), ts.alias("ts"), price.alias("price"), bid.alias("bid"),
        ask.alias("ask"), reason.alias("reason"),
    )


def valid_ticks(messages: DataFrame) -> DataFrame:
    return parse_ticks(messages).where(F.col("reason").isNull()).drop("reason")


def rejected_ticks(messages: DataFrame) -> DataFrame:
    kept = [c for c in messages.columns if c != "value"]
    return parse_ticks(messages).where(F.col("reason").isNotNull()).select(*kept, "reason")


def as_messages(ticks: DataFrame) -> DataFrame:
    """``value``: the JSON message of each tick (absent fields are left out)."""
    return ticks.select(
        *(c for c in ("seq",) if c in ticks.columns),
        F.to_json(F.struct(*(c for c in RAW_TICK.fieldNames() if c in ticks.columns))).alias("value"),
    )


def replay_ticks(features: DataFrame, max_ticks: int | None = None) -> DataFrame:
    """Feature rows as ticker messages in time order: prices as text, ``replay_index`` from 0.

    The index is counted by chunks of the timeline, not by one global sort.
    """
    keyed = features.withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    indexed = numbered(keyed, [], ["_us", "seq"], "_index")
    if max_ticks:
        indexed = indexed.where(F.col("_index") <= max_ticks)
    return indexed.select(
        "seq", F.lit("ticker").alias("type"), F.col("symbol").alias("product_id"),
        F.col("price").cast("string").alias("price"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        F.col("bid").cast("string").alias("best_bid"), F.col("ask").cast("string").alias("best_ask"),
        F.lit(True).alias("replay"), (F.col("_index") - 1).cast("long").alias("replay_index"),
    )


def replay_delay(ticks: DataFrame, speed: float = 1.0, ts: str = "ts", tiebreak: str = "seq") -> DataFrame:
    """Seconds to wait after each row before the next: max(0, gap / speed); 0 for the last row or speed 0."""
    base = ticks.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    split = split_ordered(base.select("_us", tiebreak), [], ["_us", tiebreak])
    w = Window.partitionBy(*split.keys).orderBy("_us", tiebreak)
    gap = (F.lead("_us").over(w) - F.col("_us")) / 1e6
    delay = F.greatest(gap / F.lit(float(speed)), F.lit(0.0)) if speed else F.lit(0.0)
    return (
        split.with_halo(base, rows_after=1).withColumn("delay", F.coalesce(delay, F.lit(0.0)))
        .where("_own").drop("_us", "_chunk", "_base", "_own")
    )
