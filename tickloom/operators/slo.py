"""Service indicators and objectives from a request log and offset snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.columns import band, lag_band, per
from tickloom.operators.evaluation import cumulative_buckets, ratio
from tickloom.operators.stats import time_differences

# Histogram bounds in seconds.
PREDICT_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
API_BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]
# Fixed values: (severity, limit, minutes it must hold), most severe first.
LATENCY_ALERTS = [("severe", 1.0, 2), ("critical", 0.8, 5), ("warning", 0.6, 5)]
SUCCESS_ALERTS = [("severe", 95.0, 1), ("critical", 99.0, 5), ("warning", 99.5, 5)]
LAG_ALERTS = [("severe", 10_000, 2), ("critical", 5_000, 5), ("warning", 1_000, 10)]
# The on-call handbook's own rules.
HANDBOOK_LATENCY_ALERTS = [("alert", 0.8, 5)]
HANDBOOK_ERROR_RATE_ALERTS = [("alert", 1.0, 2)]
HANDBOOK_LAG_ALERTS = [("alert", 10_000, 10)]
# Panel bands (seconds, percent, messages).
LATENCY_BANDS = [(0.5, "green"), (0.8, "yellow")]
ERROR_RATE_BANDS = [(0.5, "green"), (1.0, "yellow")]
LAG_BANDS = [(1000, "green"), (5000, "yellow"), (10000, "orange")]


def time_bucket(ts: str, seconds: int) -> Column:
    """Start of the tumbling window, as a timestamp without zone."""
    size = seconds * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    return F.timestamp_micros(F.floor(us / size) * size).cast("timestamp_ntz")


# -- lag -----------------------------------------------------------------------------------------
def consumer_lag(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag per (consumer_group, topic, partition): end offset minus the group's commit, 0 where it never committed.

    Every group is watched on all partitions of the topics that it has committed to.
    """
    groups = committed.select("consumer_group", "topic").distinct()
    commits = committed.select("consumer_group", "topic", "partition", "consumer_offset")
    watched = end_offsets.join(groups, "topic").join(commits, ["consumer_group", "topic", "partition"], "left")
    return watched.select(
        "consumer_group", "topic", "partition", "log_end_offset", F.coalesce("consumer_offset", F.lit(0)).alias("consumer_offset"),
        (F.col("log_end_offset") - F.coalesce("consumer_offset", F.lit(0))).alias("lag"),
    )


def lag_by_topic(lag: DataFrame, by: Sequence[str] = ("consumer_group", "topic")) -> DataFrame:
    total = lag.groupBy(*by).agg(F.sum("lag").alias("total_lag"), F.count(F.lit(1)).alias("partitions"))
    return total.withColumn("band", lag_band(F.col("total_lag")))


def lag_snapshots(appended: DataFrame, committed: DataFrame, seconds: int) -> DataFrame:
    """Lag per topic, partition and poll time from message times and commit times.

    ``appended``: topic, partition, ts per message; ``committed``: the same for commits.  Counts are first reduced
    to one row per poll interval; the running totals go over those.
    """
    on = ["topic", "partition", "poll"]
    ends = appended.groupBy("topic", "partition", time_bucket("ts", seconds).alias("poll")).agg(
        F.count(F.lit(1)).alias("_end"))
    done = committed.groupBy("topic", "partition", time_bucket("ts", seconds).alias("poll")).agg(
        F.count(F.lit(1)).alias("_done"))
    w = Window.partitionBy("topic", "partition").orderBy("poll").rowsBetween(Window.unboundedPreceding, 0)
    joined = ends.join(done, on, "full")
    return joined.select(
        *on, F.sum(F.coalesce("_end", F.lit(0))).over(w).alias("log_end_offset"),
        F.sum(F.coalesce("_done", F.lit(0))).over(w).alias("consumer_offset"),
    ).withColumn("lag", F.col("log_end_offset") - F.col("consumer_offset"))


# -- rates ---------------------------------------------------------------------------------------
def latency_histogram(log: DataFrame, bounds: Sequence[float] = PREDICT_BOUNDS, by: Sequence[str] = ("endpoint",)):
    return cumulative_buckets(log, "latency_seconds", bounds, by)


def histogram_quantile(buckets: DataFrame, q: float, by: Sequence[str]) -> DataFrame:
    """Quantile from cumulative buckets: linear inside the bucket that reaches rank q * N, the highest finite
    bound if that is the infinite one.  Windows run over the fixed number of buckets of a key."""
    w = Window.partitionBy(*by).orderBy("le")
    total = F.max("cumulative").over(Window.partitionBy(*by))
    inf = float("inf")
    marked = buckets.withColumns({
        "_below": F.coalesce(F.lag("cumulative").over(w), F.lit(0)),
        "_low": F.coalesce(F.lag("le").over(w), F.lit(0.0)), "_all": total,
    })
    rank = F.lit(q) * F.col("_all")
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * per(
        rank - F.col("_below"), F.col("cumulative") - F.col("_below"))
    value = F.when(F.col("le") == inf, F.col("_low")).otherwise(inside)
    hit = (F.col("cumulative") >= rank) & ((F.col("_below") < rank) | (F.col("_below") == 0))
    return marked.where((F.col("_all") > 0) & hit).groupBy(*by).agg(
        F.min_by(value, "le").alias("value")
    )


def windowed_rates(log: DataFrame, seconds: int, watermark: str | None = None, slide: int | None = None) -> DataFrame:
    """Requests, errors, per-second rate and mean latency per window (batch or streaming).

    Windows follow one another, or begin every ``slide`` seconds.  In a batch, sliding windows are put together from one row
    per step.  A stream passes a watermark and emits a window once it is closed.
    """
    failed = F.col("status").isin("400", "500", "503")
    counts = [F.count(F.lit(1)).alias("requests"), F.sum(failed.cast("long")).alias("errors"), F.sum("latency_seconds").alias("_sum")]
    if watermark:
        every = F.window("ts", f"{seconds} seconds", f"{slide or seconds} seconds")
        found = log.withWatermark("ts", watermark).groupBy(every).agg(*counts).select(F.col("window.start").alias("window_start"), "requests", "errors", "_sum")
    else:
        steps = log.groupBy(F.window("ts", f"{slide or seconds} seconds").start.alias("window_start")).agg(*counts)
        found = slid(steps, seconds, slide).groupBy("window_start").agg(*(F.sum(c).alias(c) for c in ("requests", "errors", "_sum")))
    return found.select(
        "window_start", "requests", "errors",
        (F.col("requests") / F.lit(float(seconds))).alias("per_second"),
        (F.col("_sum") / F.col("requests")).alias("mean_latency"),
    )


def slid(steps: DataFrame, seconds: int, slide: int | None, at: str = "window_start") -> DataFrame:
    """Rows of steps of ``slide`` seconds, once for each window of ``seconds`` that holds them; ``at`` is the window's begin."""
    if not slide or slide == seconds:
        return steps
    if seconds % slide:
        raise ValueError(f"a window of {seconds} s does not consist of steps of {slide} s")
    back = F.explode(F.sequence(F.lit(0), F.lit(seconds // slide - 1)))
    return steps.withColumn("_back", back).withColumn(at, F.col(at) - F.make_dt_interval(secs=F.col("_back") * slide)).drop("_back")


def request_rate(log: DataFrame, seconds: int, by: Sequence[str] = ()) -> DataFrame:
    counts = log.groupBy(time_bucket("ts", seconds).alias("window_start"), *by).agg(
        F.count(F.lit(1)).alias("requests"))
    return counts.withColumn("per_second", F.col("requests") / F.lit(float(seconds)))


def error_rate(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    counts = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"), F.sum(F.col("error_type").isNotNull().cast("long")).alias("errors"))
    return counts.withColumn("error_rate", ratio(F.col("errors") * 100, F.col("requests")))


def availability(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of finished requests with status 200; the 'processing' marks of running requests do not count."""
    done = log.where(F.col("status") != "processing")
    counts = done.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"), F.sum((F.col("status") == "200").cast("long")).alias("succeeded"))
    return counts.withColumn("availability", ratio(F.col("succeeded") * 100, F.col("requests")))


def errors_by_type(log: DataFrame, seconds: int) -> DataFrame:
    return request_rate(log.where(F.col("error_type").isNotNull()), seconds, ["error_type"]).withColumnRenamed(
        "requests", "errors")


# -- objectives ----------------------------------------------------------------------------------
def slo_status(indicators: DataFrame) -> DataFrame:
    """One row per objective from a row with p95_seconds, availability, lag and f1."""
    def row(name: str, value: Column, target: float, met: Column) -> Column:
        return F.struct(F.lit(name).alias("objective"), value.cast("double").alias("value"),
                        F.lit(float(target)).alias("target"), met.alias("met"))

    p95, up, lag, f1 = (F.col(c) for c in ("p95_seconds", "availability", "lag", "f1"))
    return indicators.select(F.inline(F.array(
        row("latency_p95", p95, 0.8, p95 <= 0.8), row("availability", up, 99.0, up >= 99.0),
        row("freshness", lag, 1000, lag < 1000), row("f1", f1, 0.75, f1 >= 0.75),
    )))


def minute_indicators(log: DataFrame, seconds: int = 60, window: int | None = None) -> DataFrame:
    """p95 latency (from the histogram), success rate and error rate per interval, or over ``window`` seconds ending with it."""
    at = log.withColumn("minute", time_bucket("ts", seconds))
    back = (window or seconds) - seconds
    shifted = F.col("minute") + F.make_dt_interval(secs=F.lit(back))
    buckets = latency_histogram(at, by=["minute"])
    done = at.where(F.col("status") != "processing").groupBy("minute").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("status") == "200").cast("long")).alias("good"),
        F.sum(F.col("error_type").isNotNull().cast("long")).alias("errors"))
    if window:
        buckets = slid(buckets, window, seconds, "minute").groupBy("minute", "le").agg(F.sum("cumulative").alias("cumulative")).withColumn("minute", shifted)
        done = slid(done, window, seconds, "minute").groupBy("minute").agg(*(F.sum(c).alias(c) for c in ("n", "good", "errors"))).withColumn("minute", shifted)
    p95 = histogram_quantile(buckets, 0.95, ["minute"]).withColumnRenamed("value", "p95")
    up = done.select("minute", ratio(F.col("good") * 100, F.col("n")).alias("success"), ratio(F.col("errors") * 100, F.col("n")).alias("error_rate"))
    return p95.join(up, "minute", "full")


def sustained_alerts(series: DataFrame, value: str, time: str, rules: Sequence[tuple[str, float, int]],
                     interval_seconds: int = 60, below: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Runs of consecutive intervals that breach a rule for at least its minutes.

    One row per run: severity, start, end, intervals, worst value.  ``series`` has one row per interval (and key),
    so the runs are found on the reduced series.  A missing interval ends a run.
    """
    level = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (interval_seconds * 1_000_000))
    v = F.col(value)
    found = None
    for severity, limit, minutes in rules:
        w = Window.partitionBy(*by).orderBy("_slot") if by else Window.orderBy("_slot")
        hits = series.where(v < limit if below else v > limit).withColumn("_slot", level)
        runs = (
            hits.withColumn("_run", F.col("_slot") - F.row_number().over(w))
            .groupBy(*by, "_run").agg(
                F.min(time).alias("first_interval"), F.max(time).alias("last_interval"),
                F.count(F.lit(1)).alias("intervals"), (F.min(v) if below else F.max(v)).alias("worst"))
            .where(F.col("intervals") >= minutes)
            .select(*by, F.lit(severity).alias("severity"), "first_interval", "last_interval", "intervals", "worst")
        )
        found = runs if found is None else found.unionByName(runs)
    return found


def growth_alerts(series: DataFrame, value: str, time: str, per_minute: float = 500.0, by: Sequence[str] = ()):
    """Intervals in which ``value`` grew by more than ``per_minute`` per minute since the interval before."""
    w = Window.partitionBy(*by).orderBy(time) if by else Window.orderBy(time)
    us = F.unix_micros(F.col(time).cast("timestamp"))
    minutes = (us - F.lag(us).over(w)) / 60_000_000
    growth = (F.col(value) - F.lag(value).over(w)) / minutes
    return series.withColumn("growth_per_minute", growth).where(F.col("growth_per_minute") > per_minute)


def error_budget(log: DataFrame, days: int = 30, latency_target: float = 0.8, latency_budget: float = 5.0,
                 availability_budget: float = 1.0) -> DataFrame:
    """Per day, over the ``days`` ending with it: percent of requests over the latency target and failed, and the
    share of each budget used.  Requests are first reduced to one row per day."""
    done = log.where(F.col("status") != "processing")
    daily = done.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("latency_seconds") > latency_target).cast("long")).alias("slow"),
        F.sum((F.col("status") != "200").cast("long")).alias("failed"),
    )
    w = Window.orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    n = F.sum("n").over(w)
    return daily.select(
        "day", (F.sum("slow").over(w) / n * 100).alias("slow_pct"), (F.sum("failed").over(w) / n * 100).alias("failed_pct"),
    ).withColumns({
        "latency_budget_used": F.col("slow_pct") / latency_budget,
        "availability_budget_used": F.col("failed_pct") / availability_budget,
    })


def rollback_decision(indicators: DataFrame) -> DataFrame:
    """Add target and urgency from latency_ms, error_rate (%), f1 and drift_share (0..1)."""
    urgent = (F.col("latency_ms") > 2000) | (F.col("error_rate") > 10)
    weak, drifted = F.col("f1") < 0.70, F.col("drift_share") > 0.5
    return indicators.withColumns({
        "target": F.when(urgent, "baseline").when(weak, "previous version")
        .when(drifted, "baseline or retrain").otherwise("keep"),
        "urgency": F.when(urgent, "immediate").when(weak, "within 1 hour").when(drifted, "within 4 hours")
        .otherwise("none"),
    })


def series_summary(series: DataFrame, value: str, time: str, limits: Sequence[tuple[float, str]], otherwise: str,
                   by: Sequence[str] = ()) -> DataFrame:
    """Mean, last known value and maximum of an indicator series, and the band of the last value."""
    known = F.col(value).isNotNull()
    out = series.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.max_by(F.when(known, F.col(value)), F.when(known, F.col(time))).alias("last"),
        F.max(value).alias("max"),
    )
    return out.withColumn("band", band(F.col("last"), limits, otherwise))


def release_gate(candidates: DataFrame, min_f1: float = 0.75, max_drift: float = 0.30, min_gain: float = 5.0):
    """Add deploy verdicts to rows with f1, current_f1 and drift_share."""
    gain = per(F.col("f1") - F.col("current_f1"), F.col("current_f1")) * 100
    return candidates.withColumn("gain_pct", gain).withColumns({
        "f1_ok": F.col("f1") > min_f1, "drift_ok": F.col("drift_share") < max_drift,
        "improves": F.col("gain_pct") >= min_gain, "holds": F.col("gain_pct") >= 0,
    }).withColumn("deploy", F.col("f1_ok") & F.col("drift_ok") & F.col("holds"))


def feed_gaps(df: DataFrame, ts: str, tiebreak: str, by: Sequence[str] = (), seconds: float = 30.0) -> DataFrame:
    """Silences longer than ``seconds`` between consecutive messages of a feed: end of silence and its length."""
    return (
        time_differences(df.select(*by, ts, tiebreak), ts, tiebreak, by).where(F.col("time_diff") > seconds)
        .select(*by, F.col(ts).alias("resumed_at"), F.col("time_diff").alias("silent_seconds"))
    )
