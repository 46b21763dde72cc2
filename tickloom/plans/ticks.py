"""Queries over ticks and features: sources, projections, as-of and window operators, order, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import columns as cols
from tickloom.operators import features as ops, slo, stats
from tickloom.operators.drift import common_columns as shared_columns, latest
from tickloom.operators.models import (
    rule_baseline, stratified_split as split_by_class, temporal_split as split_by_time, validate_features as check,
)
from tickloom.operators.ordered import numbered
from tickloom.plans.fixtures import (
    FEATURES_SQL, RAW_VALUE_TICKS_SQL, SMALL_BUFFER, TICKS_SQL, UNBOUNDED, WINDOWS, features, features_sql, raw_value_ticks,
    rounded, table, ticks,
)
from tickloom.plans.registry import ntz, query, six
from tickloom.schemas import FEATURE_ROW, FEATURES
from tickloom.session import scratch_dir
from tickloom.sources import files, ticks as raw

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def messages(spark, sf):
    """Raw messages from events: every 50th price is not a number, every 70th has no quotes, every 90th is a
    heartbeat, every 110th is cut short."""
    t = ticks(spark, sf)
    seq = F.col("seq")
    fields = t.select(
        "seq", F.when(seq % 90 == 0, "heartbeat").otherwise("ticker").alias("type"),
        F.col("symbol").alias("product_id"),
        F.when(seq % 50 == 0, "abc").otherwise(F.col("price").cast("string")).alias("price"),
        F.date_format(F.col("ts").cast("timestamp"), ISO).alias("time"),
        F.when(seq % 70 != 0, F.round("bid", 6).cast("string")).alias("best_bid"),
        F.when(seq % 70 != 0, F.round("ask", 6).cast("string")).alias("best_ask"),
        F.when(seq % 3 == 0, F.col("seq").cast("string")).alias("volume_24h"),
    )
    text = raw.as_messages(fields)
    return text.withColumn("value", F.when(seq % 110 == 0, F.expr("substr(value, 1, length(value) - 5)")).otherwise(
        F.col("value")))


# -- sources -------------------------------------------------------------------------------------
@query("read_tick_batch", f"""WITH {TICKS_SQL}
SELECT seq, symbol AS product_id, CASE WHEN seq % 50 = 0 THEN 'abc' ELSE CAST(price AS VARCHAR) END AS price,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS time,
       CASE WHEN seq % 3 = 0 THEN CAST(seq AS VARCHAR) ELSE 'N/A' END AS volume_24h
FROM ticks WHERE seq % 110 <> 0""")
def read_tick_batch(spark, sf):
    """The messages stand in text files; their replay index is the number of the tick."""
    path = scratch_dir(spark, "topic")
    sent = messages(spark, sf)
    tagged = sent.select(F.concat(F.lit('{"replay_index":'), "seq", F.lit(","), F.expr("substr(value, 2)")).alias("value"))
    tagged.write.text(path)
    read = raw.read_ticks(spark, "text", path=path)
    fields = raw.message_fields(read, {"replay_index": "seq"})
    return fields.withColumn("seq", F.col("seq").cast("long"))


@query("message_fields", f"""WITH {TICKS_SQL}
SELECT symbol AS product_id, CASE WHEN seq % 3 = 0 THEN 'known' ELSE 'N/A' END AS volume, count(*) AS messages
FROM ticks WHERE seq % 110 <> 0 GROUP BY ALL""")
def message_fields(spark, sf):
    m = raw.message_fields(messages(spark, sf))
    known = F.when(F.col("volume_24h") == "N/A", "N/A").otherwise("known")
    return m.groupBy("product_id", known.alias("volume")).agg(F.count(F.lit(1)).alias("messages"))


@query("ticker_filter", f"""WITH {TICKS_SQL}
SELECT seq, symbol AS product_id, 'ticker' AS type, true AS stamped FROM ticks
WHERE seq % 90 <> 0 AND seq % 110 <> 0""")
def ticker_filter(spark, sf):
    return raw.ticker_filter(messages(spark, sf)).select(
        "seq", "product_id", "type", F.col("ingestion_timestamp").isNotNull().alias("stamped"))


@query("undecodable_messages", "SELECT event_id AS seq FROM events WHERE event_id % 110 = 0")
def undecodable_messages(spark, sf):
    return raw.undecodable(messages(spark, sf)).select("seq")


@query("parse_ticks", f"""WITH {TICKS_SQL}
SELECT seq, symbol, ts, round(price, 6) AS price, round(CASE WHEN seq % 70 = 0 THEN price ELSE bid END, 6) AS bid,
       round(CASE WHEN seq % 70 = 0 THEN price ELSE ask END, 6) AS ask
FROM ticks WHERE seq % 50 <> 0 AND seq % 110 <> 0""")
def parse_ticks(spark, sf):
    return six(ntz(raw.valid_ticks(messages(spark, sf)), "ts"))


@query("rejected_ticks", """SELECT event_id AS seq,
       CASE WHEN event_id % 110 = 0 THEN 'invalid_json' ELSE 'price' END AS reason
FROM events WHERE event_id % 50 = 0 OR event_id % 110 = 0""")
def rejected_ticks(spark, sf):
    return raw.rejected_ticks(messages(spark, sf))


@query("write_features_topic", f"WITH {FEATURES_SQL} SELECT symbol AS key, * FROM features")
def write_features_topic(spark, sf):
    """The JSON messages, read back field by field."""
    sent = files.feature_messages(features(spark, sf))
    return ntz(sent.select("key", F.from_json("value", FEATURE_ROW).alias("f")).select("key", "f.*"), "ts")


@query("write_features_parquet", f"""WITH {FEATURES_SQL}
SELECT symbol, CAST(ts AS DATE) AS date, count(*) AS n, round(sum(price), 4) AS price_sum FROM features GROUP BY ALL""")
def write_features_parquet(spark, sf):
    path = scratch_dir(spark, "features")
    files.write_features(features(spark, sf), path)
    return spark.read.parquet(path).groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 4).alias("price_sum"))


@query("read_features", "SELECT event_id, ts, event_type, value FROM events")
def read_features(spark, sf):
    return files.read_features(spark, f"{sf}/events.parquet").select("event_id", "ts", "event_type", "value")


@query("read_first_available", "SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def read_first_available(spark, sf):
    found = files.read_first_available(spark, [f"{sf}/absent.parquet", f"{sf}/absent.csv", f"{sf}/events.parquet"])
    return found.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("read_raw_ndjson", f"""WITH {TICKS_SQL}
SELECT symbol AS product_id, CAST(price AS VARCHAR) AS price, 'ticker' AS type FROM ticks""")
def read_raw_ndjson(spark, sf):
    path = scratch_dir(spark, "raw")
    t = ticks(spark, sf).select(F.lit("ticker").alias("type"), F.col("symbol").alias("product_id"),
                                F.col("price").cast("string").alias("price"))
    t.write.json(path)
    return raw.read_raw_ndjson(spark, path).select("product_id", "price", "type")


@query("write_csv_report", f"""WITH {FEATURES_SQL}
SELECT symbol, count(*) AS n, round(max(price), 6) AS max_price FROM features GROUP BY ALL""")
def write_csv_report(spark, sf):
    path = scratch_dir(spark, "report")
    report = features(spark, sf, columns=["price"]).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.max("price").alias("max_price"))
    files.write_csv_report(report, path)
    return spark.read.option("header", True).schema("symbol string, n long, max_price double").csv(path)


@query("write_json_report", f"""WITH {FEATURES_SQL}
SELECT symbol, count(*) AS n, round(max(price), 6) AS max_price FROM features GROUP BY ALL""")
def write_json_report(spark, sf):
    path = scratch_dir(spark, "report")
    report = features(spark, sf, columns=["price"]).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.max("price").alias("max_price"))
    files.write_json_report(report, path)
    return spark.read.schema("symbol string, n long, max_price double").json(path)


@query("replay_ticks", f"""WITH {FEATURES_SQL}
SELECT seq, 'ticker' AS type, symbol AS product_id, CAST(price AS VARCHAR) AS price,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS time, CAST(bid AS VARCHAR) AS best_bid,
       CAST(ask AS VARCHAR) AS best_ask, true AS replay, row_number() OVER (ORDER BY ts, seq) - 1 AS replay_index
FROM features""")
def replay_ticks(spark, sf):
    return raw.replay_ticks(features(spark, sf, columns=["price", "bid", "ask"]))


# -- projections and predicates ------------------------------------------------------------------
@query("dedupe_same_timestamp", f"""WITH {RAW_VALUE_TICKS_SQL}, numbered AS (
  SELECT symbol, seq, ts, price, row_number() OVER w AS rn, lag(ts) OVER w AS pts FROM ticks
  WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq))
SELECT symbol, seq, ts, price FROM numbered WHERE rn = 2 OR (rn > 2 AND ts <> pts)""")
def dedupe_same_timestamp(spark, sf):
    return ops.emitted_ticks(raw_value_ticks(spark, sf)).select("symbol", "seq", "ts", "price")


@query("min_history", f"""WITH {TICKS_SQL}, numbered AS (
  SELECT symbol, seq, ts, row_number() OVER (PARTITION BY symbol ORDER BY ts, seq) AS rn FROM ticks)
SELECT * FROM numbered WHERE rn >= 2""")
def min_history(spark, sf):
    return ops.with_history(ticks(spark, sf)).select("symbol", "seq", "ts", "rn")


@query("feature_columns", f"WITH {FEATURES_SQL} SELECT {', '.join(FEATURES)} FROM features")
def feature_columns(spark, sf):
    f = features(spark, sf)
    return f.select(*(c for c in f.columns if c not in ("symbol", "seq", "ts", "volatility_spike")))


@query("common_columns", f"""WITH {FEATURES_SQL}
SELECT 'reference' AS side, price, spread FROM features WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL SELECT 'current', price, spread FROM features WHERE ts >= TIMESTAMP '2024-01-16'""")
def common_columns(spark, sf):
    f = features(spark, sf, columns=["price", "bid", "ask", "spread"])
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    old, new = f.where(F.col("ts") < cut).drop("bid", "seq"), f.where(F.col("ts") >= cut).drop("ask", "symbol")
    shared = shared_columns(old, new, FEATURES)
    return old.select(F.lit("reference").alias("side"), *shared).unionByName(
        new.select(F.lit("current").alias("side"), *shared))


@query("spike_label", f"""WITH {FEATURES_SQL}
SELECT symbol, seq, CAST(volatility_60s > 11.5 AS INTEGER) AS volatility_spike FROM features""")
def spike_label(spark, sf):
    f = features(spark, sf, columns=["volatility_60s"])
    return f.select("symbol", "seq", cols.spike_label(F.col("volatility_60s"), 11.5).alias("volatility_spike"))


@query("validate_features", """
SELECT event_id AS seq, array_to_string(list_filter([
    CASE WHEN event_id % 7 = 0 THEN 'price' END, CASE WHEN event_id % 11 = 0 THEN 'spread' END
  ], lambda x: x IS NOT NULL), ',') AS reasons, NOT (event_id % 7 = 0 OR event_id % 11 = 0) AS valid FROM events""")
def validate_features(spark, sf):
    """Requests with a missing price or a spread that is not a number."""
    e = table(spark, sf, "events")
    wide = e.select(F.col("event_id").alias("seq"), *(F.col("value").alias(c) for c in FEATURES))
    wide = wide.withColumns({
        "price": F.when(F.col("seq") % 7 != 0, F.col("price")),
        "spread": F.when(F.col("seq") % 11 == 0, "wide").otherwise(F.col("spread").cast("string")),
    })
    return check(wide).select("seq", F.array_join("reasons", ",").alias("reasons"), "valid")


@query("liquidity_status", f"""WITH {FEATURES_SQL} SELECT seq, CASE WHEN spread < 0.01 THEN 'High'
WHEN spread < 0.05 THEN 'Medium' ELSE 'Low' END AS liquidity FROM features""")
def liquidity_status(spark, sf):
    return features(spark, sf, columns=["spread"]).select(
        "seq", cols.liquidity_status(F.col("spread")).alias("liquidity"))


@query("activity_status", f"""WITH {FEATURES_SQL} SELECT seq, CASE WHEN intensity_30s * 1000 < 1 THEN 'Quiet'
WHEN intensity_30s * 1000 < 5 THEN 'Normal' ELSE 'Active' END AS activity FROM features""")
def activity_status(spark, sf):
    """Intensities per 1000 s, as the events are sparse."""
    return features(spark, sf, columns=["intensity_30s"]).select(
        "seq", cols.activity_status(F.col("intensity_30s") * 1000).alias("activity"))


@query("range_checks", f"""WITH {FEATURES_SQL}
SELECT CAST(sum(CAST(spread <= 0 AS INTEGER)) AS BIGINT) AS spread_not_positive,
       CAST(sum(CAST(volatility_30s < 0 OR volatility_60s < 0 OR volatility_120s < 0 AS INTEGER)) AS BIGINT)
         AS negative_volatility,
       CAST(sum(CAST(ask < bid AS INTEGER)) AS BIGINT) AS crossed_quotes,
       CAST(sum(CAST(price <= 0 AS INTEGER)) AS BIGINT) AS price_not_positive FROM features""")
def range_checks(spark, sf):
    rules = {
        "spread_not_positive": F.col("spread") <= 0,
        "negative_volatility": (F.col("volatility_30s") < 0) | (F.col("volatility_60s") < 0)
        | (F.col("volatility_120s") < 0),
        "crossed_quotes": F.col("ask") < F.col("bid"), "price_not_positive": F.col("price") <= 0,
    }
    return features(spark, sf).agg(*(F.sum(c.cast("long")).alias(n) for n, c in rules.items()))


# -- as-of and windows ---------------------------------------------------------------------------
@query("tick_features", f"WITH {FEATURES_SQL} SELECT * FROM features")
def tick_features(spark, sf):
    return features(spark, sf)


@query("tick_features_small_buffer",
       f"WITH {TICKS_SQL}, {features_sql(SMALL_BUFFER)} SELECT * FROM features")
def tick_features_small_buffer(spark, sf):
    return features(spark, sf, SMALL_BUFFER)


@query("tick_features_unbounded", f"WITH {TICKS_SQL}, {features_sql(UNBOUNDED)} SELECT * FROM features")
def tick_features_unbounded(spark, sf):
    """Without a limit on the buffer: windows hold all of their ticks, past prices are of any age."""
    return features(spark, sf, UNBOUNDED)


@query("tick_features_price_guards",
       f"WITH {RAW_VALUE_TICKS_SQL}, {features_sql()} SELECT * FROM features")
def tick_features_price_guards(spark, sf):
    return rounded(ops.tick_features(raw_value_ticks(spark, sf), WINDOWS))


for _name, _columns in {
    "returns": ["return_10s", "return_30s", "return_60s"],
    "volatility": ["volatility_30s", "volatility_60s", "volatility_120s"],
    "spread": ["spread"],
    "intensity": ["intensity_30s", "intensity_60s", "intensity_120s"],
}.items():
    query(_name, f"WITH {FEATURES_SQL} SELECT symbol, seq, ts, {', '.join(_columns)} FROM features")(
        lambda spark, sf, c=_columns: features(spark, sf, columns=c))


@query("asof_past_price", f"""WITH {TICKS_SQL}, emitted AS (
  SELECT *, lag(ts) OVER (PARTITION BY symbol ORDER BY ts, seq) AS pts, ts - INTERVAL 3600 SECONDS AS cut FROM ticks)
SELECT e.symbol, e.seq, e.ts, round(e.price, 6) AS price, round(p.price, 6) AS past_price
FROM emitted e ASOF LEFT JOIN ticks p ON e.symbol = p.symbol AND e.cut >= p.ts WHERE e.pts IS NOT NULL""")
def asof_past_price(spark, sf):
    return six(ops.asof_past_price(ticks(spark, sf), 3600))


@query("tick_returns", f"""WITH {TICKS_SQL}, numbered AS (
  SELECT *, row_number() OVER w AS rn, lag(price) OVER w AS pp FROM ticks
  WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq))
SELECT symbol, seq, ts, round(price, 6) AS price, rn,
       round(CASE WHEN pp > 0 THEN (price - pp) / pp * 100 END, 6) AS tick_return FROM numbered""")
def tick_returns(spark, sf):
    return six(ops.tick_returns(ticks(spark, sf)))


@query("future_window", f"""WITH {TICKS_SQL}, keyed AS (SELECT *, epoch_us(ts) AS us FROM ticks)
SELECT symbol, ts, count(price) OVER w AS future_ticks, round(first(price) OVER w, 6) AS future_first,
       round(last(price) OVER w, 6) AS future_last
FROM keyed WINDOW w AS (PARTITION BY symbol ORDER BY us RANGE BETWEEN 1 FOLLOWING AND 21600000000 FOLLOWING)""")
def future_window(spark, sf):
    return six(ops.future_window(ticks(spark, sf), 21600))


FUTURE_SQL = f"""{TICKS_SQL}, stepped AS (
  SELECT *, epoch_us(ts) AS us, lag(price) OVER (PARTITION BY symbol ORDER BY ts, seq) AS pp FROM ticks
), moved AS (
  SELECT *, CASE WHEN pp > 0 THEN (price - pp) / pp * 100 END AS r FROM stepped
), pairs AS (
  SELECT t.symbol, t.ts, t.us, f.r, row_number() OVER (PARTITION BY t.symbol, t.seq ORDER BY f.us) AS nth
  FROM moved t LEFT JOIN moved f ON f.symbol = t.symbol AND f.us > t.us AND f.us <= t.us + 21600000000
), future AS (
  SELECT symbol, ts, any_value(us) AS us, round(coalesce(stddev_samp(CASE WHEN nth > 1 THEN r END), 0.0), 6)
         AS future_volatility FROM pairs GROUP BY symbol, ts
)"""


@query("future_volatility", f"""WITH {FUTURE_SQL}
SELECT symbol, ts, future_volatility, CAST(future_volatility >= 5 AS INTEGER) AS future_spike,
       us + 21600000000 <= (SELECT max(epoch_us(ts)) FROM events) AS complete FROM future""")
def future_volatility(spark, sf):
    return six(ops.future_volatility(ticks(spark, sf), 21600, 5.0))


@query("price_move_spike", f"""WITH {TICKS_SQL}, emitted AS (
  SELECT *, lag(ts) OVER (PARTITION BY symbol ORDER BY ts, seq) AS pts, ts - INTERVAL 1800 SECONDS AS cut FROM ticks)
SELECT e.symbol, e.seq, CAST(coalesce(abs((e.price - p.price) / p.price * 100) > 0.2, false) AS INTEGER) AS spike
FROM emitted e ASOF LEFT JOIN ticks p ON e.symbol = p.symbol AND e.cut >= p.ts WHERE e.pts IS NOT NULL""")
def price_move_spike(spark, sf):
    """Alternative label: more than 0.2 % within 5 s (1800 s here)."""
    past = ops.asof_past_price(ticks(spark, sf), 1800)
    moved = F.abs(cols.percent_change(F.col("price"), F.col("past_price"))) > 0.2
    return past.select("symbol", "seq", F.coalesce(moved, F.lit(False)).cast("int").alias("spike"))


@query("rolling_mean", """SELECT event_id, ts, value, round(CASE WHEN count(*) OVER w = size THEN avg(value) OVER w END,
  6) AS rolling_mean FROM events, (SELECT 100 AS size)
WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""")
def rolling_mean(spark, sf):
    return six(stats.rolling_mean(table(spark, sf, "events"), "value", "ts", "event_id"), "rolling_mean").select(
        "event_id", "ts", "value", "rolling_mean")


@query("time_diff", """SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn,
  (epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts, event_id)) / 1e6::DOUBLE AS time_diff FROM events""")
def time_diff(spark, sf):
    return stats.time_differences(table(spark, sf, "events").select("event_id", "ts"), "ts", "event_id").select(
        "event_id", "rn", "time_diff")


@query("replay_delay", """SELECT event_id, coalesce(greatest(
  (lead(epoch_us(ts)) OVER (ORDER BY ts, event_id) - epoch_us(ts)) / 1e6::DOUBLE / 10, 0), 0) AS delay FROM events""")
def replay_delay(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    return raw.replay_delay(e, 10.0, "ts", "event_id").select("event_id", "delay")


@query("progress_by_count", """SELECT * FROM (
  SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events) WHERE rn % 100 = 0""")
def progress_by_count(spark, sf):
    """Every hundredth processed row: what a progress line would report."""
    e = table(spark, sf, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return numbered(e, [], ["us", "event_id"]).where(F.col("rn") % 100 == 0).select(
        "event_id", F.col("rn").cast("long").alias("rn"))


TEMPORAL_SQL = """SELECT event_id, CASE WHEN epoch_us(ts) <= a THEN 'train' WHEN epoch_us(ts) <= b THEN 'validation'
  ELSE 'test' END AS split, CAST(value > 50 AS INTEGER) AS label, ts FROM events, (
  SELECT quantile_cont(epoch_us(ts)::DOUBLE, 0.7) AS a, quantile_cont(epoch_us(ts)::DOUBLE, 0.85) AS b FROM events)"""


def _temporal(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", (F.col("value") > 50).cast("int").alias("label"))
    return split_by_time(e, "ts", [("train", 0.7), ("validation", 0.15), ("test", 0.15)])


@query("temporal_split", TEMPORAL_SQL)
def temporal_split(spark, sf):
    return _temporal(spark, sf)


@query("temporal_split_80_20", """SELECT event_id, CASE WHEN epoch_us(ts) <= a THEN 'train' ELSE 'test' END AS split
FROM events, (SELECT quantile_cont(epoch_us(ts)::DOUBLE, 0.8) AS a FROM events)""")
def temporal_split_80_20(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    return split_by_time(e, "ts", [("train", 0.8), ("test", 0.2)]).drop("ts")


@query("split_summary", f"""SELECT split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS spikes,
  round(avg(label) * 100, 6) AS spike_rate, min(ts) AS first_ts, max(ts) AS last_ts,
  count(*) - CAST(sum(label) AS BIGINT) AS normals, round(count(*) / (SELECT count(*) FROM events) * 100, 6)
  AS share_pct FROM ({TEMPORAL_SQL}) GROUP BY split""")
def split_summary(spark, sf):
    return six(stats.split_summary(_temporal(spark, sf), "split", "label", "ts"))


@query("stratified_split", """WITH hashed AS (
  SELECT event_id, CAST(value > 50 AS INTEGER) AS label,
         CAST('0x' || substr(md5(concat(CAST(event_id AS VARCHAR), '#42')), 1, 15) AS BIGINT) AS h FROM events
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) AS k, count(*) OVER (PARTITION BY label) AS n
  FROM hashed)
SELECT event_id, label, CASE WHEN k <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM ranked""")
def stratified_split(spark, sf):
    e = table(spark, sf, "events").select("event_id", (F.col("value") > 50).cast("int").alias("label"))
    return split_by_class(e, "label", "event_id")


# -- order, limits, set operations ---------------------------------------------------------------
@query("sort_by_time", "SELECT event_id, ts FROM events ORDER BY ts, event_id")
def sort_by_time(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts").orderBy("ts", "event_id")


@query("head_n", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 10")
def head_n(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "value").orderBy("ts", "event_id").limit(10)


@query("tail_n", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 5000")
def tail_n(spark, sf):
    """The most recent 5 000 rows, which a drift run takes as its current sample."""
    return latest(table(spark, sf, "events").select("event_id", "ts", "value"), "ts", "event_id", 5000)


@query("append_union", """SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-20'
UNION ALL SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10'""")
def append_union(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    old = e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return old.unionByName(e.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")))


@query("feed_gaps", """SELECT symbol, resumed_at, silent_seconds FROM (
  SELECT event_type AS symbol, ts AS resumed_at, (epoch_us(ts) - lag(epoch_us(ts)) OVER (
    PARTITION BY event_type ORDER BY ts, event_id)) / 1e6::DOUBLE AS silent_seconds FROM events)
WHERE silent_seconds > 3600""")
def feed_gaps(spark, sf):
    return slo.feed_gaps(ticks(spark, sf).select("symbol", "ts", "seq"), "ts", "seq", ["symbol"], 3600.0)


# -- baselines on features -----------------------------------------------------------------------
RULE_SQL = """tenths AS (
  SELECT *, CASE WHEN (volatility_30s + volatility_60s) / 2 > 0.03 THEN 5 ELSE 0 END
    + CASE WHEN abs(return_60s) > 0.01 THEN 3 ELSE 0 END + CASE WHEN intensity_60s > 50 THEN 2 ELSE 0 END AS t
  FROM scaled)"""
SCALED_SQL = """scaled AS (SELECT symbol, seq, volatility_30s / 400 AS volatility_30s,
  volatility_60s / 400 AS volatility_60s, return_60s / 1000 AS return_60s, intensity_60s * 60000 AS intensity_60s
  FROM features)"""


def scaled_features(spark, sf):
    """Features brought to the magnitude at which the fixed rule thresholds separate."""
    f = features(spark, sf, columns=["volatility_30s", "volatility_60s", "return_60s", "intensity_60s"])
    return f.select("symbol", "seq", (F.col("volatility_30s") / 400).alias("volatility_30s"),
                    (F.col("volatility_60s") / 400).alias("volatility_60s"),
                    (F.col("return_60s") / 1000).alias("return_60s"),
                    (F.col("intensity_60s") * 60000).alias("intensity_60s"))


@query("rule_baseline", f"""WITH {FEATURES_SQL}, {SCALED_SQL}, {RULE_SQL}
SELECT symbol, seq, t / 10 AS score, CAST(t > 5 AS INTEGER) AS prediction, (10 - t) / 10 AS p_normal,
       t / 10 AS p_spike FROM tenths""")
def rule_baseline_query(spark, sf):
    return rule_baseline(scaled_features(spark, sf)).select(
        "symbol", "seq", "score", "prediction", "p_normal", "p_spike")
