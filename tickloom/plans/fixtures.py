"""How the driver's tables stand in for ticks, request logs, offsets and samples (same rules in DataFrame and SQL).

``events`` becomes the tick stream: symbol = event_type, seq = event_id, price = 1000 + value, and bid / ask around
it by props.k.  Events are minutes apart, so windows are 360 times as long as the live ones.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.operators.features import tick_features
from tickloom.schemas import FEATURES, FeatureWindows
from tickloom.session import written

SCALE = 360
WINDOWS = FeatureWindows().scaled(SCALE)
SMALL_BUFFER = FeatureWindows().scaled(SCALE, buffer_size=25)
UNBOUNDED = replace(WINDOWS, buffer_size=None)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    price = F.lit(1000.0) + F.col("value")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("seq"), "ts", price.alias("price"),
        (price * (1 - k / 10000)).alias("bid"), (price * (1 + k / 10000)).alias("ask"),
    )


TICKS_SQL = """
ticks AS (
  SELECT event_type AS symbol, event_id AS seq, ts, 1000.0::DOUBLE + value AS price,
         (1000.0::DOUBLE + value) * (1 - k / 10000) AS bid,
         (1000.0::DOUBLE + value) * (1 + k / 10000) AS ask
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
)"""


def raw_value_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks whose price is the bare value: zero and near-zero prices reach the guards; times cut to 10 minutes."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("seq"),
        F.timestamp_micros(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 600_000_000) * 600_000_000)
        .cast("timestamp_ntz").alias("ts"),
        F.floor("value").cast("double").alias("price"),
        F.floor("value").cast("double").alias("bid"), F.floor("value").cast("double").alias("ask"),
    )


RAW_VALUE_TICKS_SQL = """
ticks AS (
  SELECT event_type AS symbol, event_id AS seq,
         make_timestamp((epoch_us(ts) // 600000000) * 600000000) AS ts,
         floor(value) AS price, floor(value) AS bid, floor(value) AS ask
  FROM events
)"""


def features_sql(windows: FeatureWindows = WINDOWS, name: str = "features") -> str:
    """CTEs that compute the feature table from a CTE named ticks, by RANGE frames over a composite key."""
    size = windows.buffer_size or 1 << 60  # none: more than any symbol has
    unit = 1_000_000_000  # one second of the key: microseconds x 1000
    frames, cols = [], []
    for n, s in windows.returns.items():
        frames.append(
            f"last(struct_pack(price := price, rn := rn)) OVER (PARTITION BY symbol ORDER BY key "
            f"RANGE BETWEEN UNBOUNDED PRECEDING AND {s * unit - 999} PRECEDING) AS past_{n}"
        )
        cols.append(
            f"CASE WHEN past_{n}.rn > rn - {size} AND past_{n}.price > 0 "
            f"THEN (price - past_{n}.price) / past_{n}.price * 100 ELSE 0.0 END AS {n}"
        )
    for n, s in windows.volatility.items():
        over = f"(PARTITION BY symbol ORDER BY key RANGE BETWEEN {s * unit} PRECEDING AND CURRENT ROW)"
        frames.append(f"count(*) OVER {over} AS c_{n}, stddev_samp(r) OVER {over} AS sd_{n}")
        cols.append(f"coalesce(CASE WHEN c_{n} >= {size} THEN sd_full ELSE sd_{n} END, 0.0) AS {n}")
    for n, s in windows.intensity.items():
        frames.append(
            f"count(*) OVER (PARTITION BY symbol ORDER BY key RANGE BETWEEN {s * unit} PRECEDING "
            f"AND CURRENT ROW) AS c_{n}"
        )
        cols.append(
            f"CASE WHEN least(c_{n}, {size}) >= 2 THEN least(c_{n}, {size}) / {float(s)} ELSE 0.0 END AS {n}"
        )
    rows = "UNBOUNDED" if windows.buffer_size is None else size - 2
    frames.append(f"stddev_samp(r) OVER (PARTITION BY symbol ORDER BY key ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW) AS sd_full")
    rounded = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES)
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, seq) AS rn,
         lag(price) OVER (PARTITION BY symbol ORDER BY ts, seq) AS pp,
         lag(ts) OVER (PARTITION BY symbol ORDER BY ts, seq) AS pts,
         epoch_us(ts) * 1000 + row_number() OVER (PARTITION BY symbol, ts ORDER BY seq) - 1 AS key
  FROM ticks
), returned AS (
  SELECT *, CASE WHEN pp > 0 THEN (price - pp) / pp * 100 END AS r FROM ranked
), framed AS (
  SELECT *, {", ".join(frames)} FROM returned
), raw_{name} AS (
  SELECT symbol, seq, ts, price, bid, ask, {", ".join(cols)},
         CASE WHEN price > 0 AND ask >= bid THEN (ask - bid) / price * 100 ELSE 0.0 END AS spread
  FROM framed WHERE rn = 2 OR (rn > 2 AND ts <> pts)
), {name} AS (
  SELECT symbol, seq, ts, {rounded} FROM raw_{name}
)"""


def rounded(df: DataFrame, columns: list[str] = FEATURES, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns if c in df.columns})


def features(spark: SparkSession, sf: str, windows: FeatureWindows = WINDOWS, columns=None) -> DataFrame:
    """The feature table of ``events``, rounded so that both engines agree on every later comparison."""
    return rounded(tick_features(ticks(spark, sf), windows, columns=columns))


def stored_features(spark: SparkSession, sf: str, columns=None) -> DataFrame:
    """The feature table as written by the feature job, for profiles that read it several times."""
    return written(features(spark, sf, columns=columns), "features")


FEATURES_SQL = TICKS_SQL + "," + features_sql()


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Request log: latency = value / 100 s, status by event type, endpoint by user, one row per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    failed = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        F.col("event_id").alias("request_id"), "ts",
        F.when(F.col("user_id") % 2 == 0, "/predict").otherwise("/predict/batch").alias("endpoint"),
        F.when(failed, "500").when(F.col("event_type") == "signup", "processing").otherwise("200").alias("status"),
        (F.col("value") / 100).alias("latency_seconds"),
        F.when(failed, F.element_at(
            F.array(F.lit("model_not_loaded"), F.lit("invalid_input"), F.lit("internal_error")), k % 3 + 1
        )).alias("error_type"),
        F.lit("1.0").alias("model_version"),
        F.when(~failed, (k > 80).cast("int")).alias("prediction"),
        F.when(~failed, k / 100).alias("probability"),
    )


REQUESTS_SQL = """
requests AS (
  SELECT event_id AS request_id, ts,
         CASE WHEN user_id % 2 = 0 THEN '/predict' ELSE '/predict/batch' END AS endpoint,
         CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN 'processing' ELSE '200' END AS status,
         value / 100 AS latency_seconds,
         CASE WHEN event_type = 'error' THEN
           CASE k % 3 WHEN 0 THEN 'model_not_loaded' WHEN 1 THEN 'invalid_input' ELSE 'internal_error' END
         END AS error_type,
         '1.0' AS model_version,
         CASE WHEN event_type <> 'error' THEN CAST(k > 80 AS INTEGER) END AS prediction,
         CASE WHEN event_type <> 'error' THEN k / 100.0::DOUBLE END AS probability
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


def offsets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Log-end offsets per (topic, partition), and the commits of two groups.

    'featurizer' is at 25 January and never committed on partition 2 of 'view'; 'auditor' is at 10 January and does not read 'error'.
    """
    e = table(spark, sf, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), "ts"
    )
    end = e.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("log_end_offset"))

    def commits(group: str, until: str, read: Column) -> DataFrame:
        done = e.where((F.col("ts") < F.lit(until).cast("timestamp_ntz")) & read)
        return done.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("consumer_offset")).withColumn("consumer_group", F.lit(group))

    committed = commits("featurizer", "2024-01-25", ~((F.col("topic") == "view") & (F.col("partition") == 2)))
    return end, committed.unionByName(commits("auditor", "2024-01-10", F.col("topic") != "error"))


OFFSETS_SQL = """
placed AS (SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS partition, ts FROM events),
end_offsets AS (SELECT topic, partition, count(*) AS log_end_offset FROM placed GROUP BY ALL),
committed AS (
  SELECT 'featurizer' AS consumer_group, topic, partition, count(*) AS consumer_offset FROM placed
  WHERE ts < TIMESTAMP '2024-01-25' AND NOT (topic = 'view' AND partition = 2) GROUP BY ALL
  UNION ALL SELECT 'auditor', topic, partition, count(*) FROM placed WHERE ts < TIMESTAMP '2024-01-10' AND topic <> 'error' GROUP BY ALL
)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Scored table: labels joined to documents; score = n_chars, y_true = quality, y_pred = score > 2000."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return labels.join(docs, "doc_id").select(
        "doc_id", F.col("quality").cast("int").alias("y_true"), F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") > 2000).cast("int").alias("y_pred"),
    )


SCORED_SQL = """
scored AS (
  SELECT doc_id, CAST(quality AS INTEGER) AS y_true, CAST(n_chars AS DOUBLE) AS score,
         CAST(n_chars > 2000 AS INTEGER) AS y_pred
  FROM labels JOIN documents USING (doc_id)
)"""

DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DRIFT_CUT = "1998-01-01"


def drift_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Order lines shipped before / from a fixed day; the later extended prices raised by 5 %, so that one drifts."""
    line = table(spark, sf, "lineitem").select(*DRIFT_COLUMNS, "l_returnflag", "l_shipdate")
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    old = line.where(F.col("l_shipdate") < cut).drop("l_shipdate")
    new = line.where(F.col("l_shipdate") >= cut).drop("l_shipdate")
    return old, new.withColumn("l_extendedprice", F.col("l_extendedprice") * 1.05)


DRIFT_SQL = f"""
reference AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem
  WHERE l_shipdate < TIMESTAMP '{DRIFT_CUT}'
), current_rows AS (
  SELECT l_quantity, l_extendedprice * 1.05::DOUBLE AS l_extendedprice, l_discount, l_tax, l_returnflag
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '{DRIFT_CUT}'
)"""


def daily_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions per day: y_true = value > 50, y_pred = k > 50."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("day"), (F.col("value") > 50).cast("int").alias("y_true"),
        (k > 50).cast("int").alias("y_pred"),
    )


DAILY_SQL = """
daily AS (
  SELECT CAST(ts AS DATE) AS day, CAST(value > 50 AS INTEGER) AS y_true,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) > 50 AS INTEGER) AS y_pred
  FROM events
)"""
