"""Queries on lag, latency, availability, alerts and release decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import columns as cols
from tickloom.operators import slo
from tickloom.plans.fixtures import OFFSETS_SQL, REQUESTS_SQL, offsets, requests, table
from tickloom.plans.profiles import MODELS_SQL, model_metrics
from tickloom.plans.registry import ntz, query, six

LAG_SQL = f"""{OFFSETS_SQL}, lag_rows AS (
  SELECT consumer_group, topic, partition, log_end_offset, coalesce(consumer_offset, 0) AS consumer_offset,
         log_end_offset - coalesce(consumer_offset, 0) AS lag
  FROM (SELECT DISTINCT consumer_group, topic FROM committed) JOIN end_offsets USING (topic)
  LEFT JOIN committed USING (consumer_group, topic, partition)
), topics AS (SELECT consumer_group, topic, CAST(sum(lag) AS BIGINT) AS total_lag, count(*) AS partitions FROM lag_rows GROUP BY ALL)"""


@query("consumer_lag", f"WITH {LAG_SQL} SELECT * FROM lag_rows")
def consumer_lag(spark, sf):
    return slo.consumer_lag(*offsets(spark, sf))


@query("lag_by_topic", f"""WITH {LAG_SQL} SELECT consumer_group, topic, total_lag, partitions, CASE WHEN total_lag < 1000 THEN 'green'
  WHEN total_lag < 5000 THEN 'yellow' WHEN total_lag < 10000 THEN 'orange' ELSE 'red' END AS band FROM topics""")
def lag_by_topic(spark, sf):
    return slo.lag_by_topic(slo.consumer_lag(*offsets(spark, sf)))


@query("lag_of_topics", f"""WITH {LAG_SQL} SELECT consumer_group, topic, total_lag FROM topics WHERE topic IN ('view', 'click')""")
def lag_of_topics(spark, sf):
    """A watched list of topics is a predicate on one table, pushed below the join."""
    end, committed = offsets(spark, sf)
    watched = end.where(F.col("topic").isin("view", "click"))
    return slo.lag_by_topic(slo.consumer_lag(watched, committed)).select("consumer_group", "topic", "total_lag")


@query("lag_band", f"""WITH {LAG_SQL} SELECT consumer_group, topic, partition, CASE WHEN lag * 10 < 1000 THEN 'green'
  WHEN lag * 10 < 5000 THEN 'yellow' WHEN lag * 10 < 10000 THEN 'orange' ELSE 'red' END AS band FROM lag_rows""")
def lag_band(spark, sf):
    lag = slo.consumer_lag(*offsets(spark, sf))
    return lag.select("consumer_group", "topic", "partition", cols.lag_band(F.col("lag") * 10).alias("band"))


SNAPSHOT_SQL = """ends AS (
  SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS partition,
    make_timestamp((epoch_us(ts) // 86400000000) * 86400000000) AS poll, count(*) AS e,
    count(*) FILTER (value < 60) AS d FROM events GROUP BY ALL
), snapshots AS (SELECT topic, partition, poll, CAST(sum(e) OVER w AS BIGINT) AS log_end_offset,
  CAST(sum(d) OVER w AS BIGINT) AS consumer_offset FROM ends WINDOW w AS (PARTITION BY topic, partition ORDER BY poll))"""


def _snapshots(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), "ts", "value")
    return slo.lag_snapshots(e, e.where(F.col("value") < 60), 86_400)


@query("lag_snapshot", f"WITH {SNAPSHOT_SQL} SELECT *, log_end_offset - consumer_offset AS lag FROM snapshots")
def lag_snapshot(spark, sf):
    return _snapshots(spark, sf)


@query("lag_growth_alerts", f"""WITH {SNAPSHOT_SQL}, t AS (SELECT topic, poll, CAST(sum(log_end_offset - consumer_offset) AS
  BIGINT) AS lag FROM snapshots GROUP BY topic, poll), g AS (
  SELECT topic, poll, lag, (lag - lag(lag) OVER w) / ((epoch_us(poll) - epoch_us(lag(poll) OVER w)) / 60000000) AS growth
  FROM t WINDOW w AS (PARTITION BY topic ORDER BY poll))
SELECT topic, poll, lag, round(growth, 6) AS growth_per_minute FROM g WHERE growth > 0.005""")
def lag_growth_alerts(spark, sf):
    lag = _snapshots(spark, sf).groupBy("topic", "poll").agg(F.sum("lag").alias("lag"))
    return six(slo.growth_alerts(lag, "lag", "poll", 0.005, by=["topic"]))


# -- histograms and rates ------------------------------------------------------------------------
def _buckets_sql(bounds: list[float], key: str, source: str = "requests") -> str:
    return f"""buckets AS (SELECT {key}, le, count(*) FILTER (latency_seconds <= le) AS cumulative
  FROM {source}, (SELECT unnest([{', '.join(map(str, bounds))}, 'inf'::DOUBLE]) AS le) GROUP BY ALL)"""


def _quantiles_sql(q: float, key: str, name: str = "quantiles") -> str:
    return f"""marked_{name} AS (
  SELECT *, coalesce(lag(cumulative) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS low,
    max(cumulative) OVER (PARTITION BY {key}) AS total FROM buckets WINDOW w AS (PARTITION BY {key} ORDER BY le)
), {name} AS (
  SELECT {key}, CASE WHEN isinf(le) THEN low ELSE low + (le - low) * ({q} * total - below) / (cumulative - below) END
    AS value FROM marked_{name} WHERE total > 0 AND cumulative >= {q} * total
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY le) = 1)"""


@query("latency_histogram", f"WITH {REQUESTS_SQL}, {_buckets_sql(slo.PREDICT_BOUNDS, 'endpoint')} SELECT * FROM buckets")
def latency_histogram(spark, sf):
    return slo.latency_histogram(requests(spark, sf))


@query("api_latency_histogram", f"WITH {REQUESTS_SQL}, {_buckets_sql(slo.API_BOUNDS, 'endpoint')} SELECT * FROM buckets")
def api_latency_histogram(spark, sf):
    return slo.latency_histogram(requests(spark, sf), slo.API_BOUNDS)


for _q, _name in ((0.5, "histogram_quantile_p50"), (0.95, "histogram_quantile"), (0.99, "histogram_quantile_p99")):
    query(_name, f"""WITH {REQUESTS_SQL}, {_buckets_sql(slo.PREDICT_BOUNDS, 'endpoint')}, {_quantiles_sql(_q, 'endpoint')}
SELECT endpoint, round(value, 6) AS value FROM quantiles""")(
        lambda spark, sf, q=_q: six(slo.histogram_quantile(slo.latency_histogram(requests(spark, sf)), q, ["endpoint"])))


RATE_SQL = "make_timestamp((epoch_us(ts) // {us}) * {us})"
_6H = RATE_SQL.format(us=21_600_000_000)


@query("windowed_rates", f"""WITH {REQUESTS_SQL}
SELECT {_6H} AS window_start, count(*) AS requests, count(*) FILTER (status IN ('400', '500', '503')) AS errors,
  round(count(*) / 21600, 6) AS per_second, round(sum(latency_seconds) / count(*), 6) AS mean_latency
FROM requests GROUP BY 1""")
def windowed_rates(spark, sf):
    return six(ntz(slo.windowed_rates(requests(spark, sf), 21_600), "window_start"))


#: Six hours back, every hour: the windows that begin at each of the five hours before a row's own, and at its own.
SLIDING_SQL = f"""stepped AS (SELECT {RATE_SQL.format(us=3_600_000_000)} AS step, * FROM requests),
backs AS (SELECT unnest(range(6)) AS back), sliding AS (
  SELECT step - to_hours(CAST(back AS INTEGER)) AS window_start, count(*) AS requests, count(*) FILTER (status IN ('400', '500', '503')) AS errors,
    round(count(*) / 21600, 6) AS per_second, round(sum(latency_seconds), 4) AS total_latency
  FROM stepped, backs GROUP BY 1)"""


def total_latency(rates):
    """The mean times the requests: a sum of four digits, which both engines round alike."""
    return rates.withColumn("total_latency", F.round(F.col("mean_latency") * F.col("requests"), 4)).drop("mean_latency")


@query("sliding_rates", f"""WITH {REQUESTS_SQL}, {SLIDING_SQL} SELECT * FROM sliding""")
def sliding_rates(spark, sf):
    """A rate over the last six hours, evaluated every hour."""
    return six(total_latency(ntz(slo.windowed_rates(requests(spark, sf), 21_600, slide=3_600), "window_start")), "per_second")


@query("request_rate", f"""WITH {REQUESTS_SQL}
SELECT {_6H} AS window_start, endpoint, count(*) AS requests, round(count(*) / 21600, 6) AS per_second
FROM requests GROUP BY ALL""")
def request_rate(spark, sf):
    return six(slo.request_rate(requests(spark, sf), 21_600, ["endpoint"]))


@query("error_rate", f"""WITH {REQUESTS_SQL}
SELECT endpoint, count(*) AS requests, count(error_type) AS errors, round(count(error_type) * 100 / count(*), 6)
  AS error_rate FROM requests GROUP BY endpoint""")
def error_rate(spark, sf):
    return six(slo.error_rate(requests(spark, sf), ["endpoint"]))


@query("availability", f"""WITH {REQUESTS_SQL}
SELECT endpoint, count(*) AS requests, count(*) FILTER (status = '200') AS succeeded,
  round(count(*) FILTER (status = '200') * 100 / count(*), 6) AS availability
FROM requests WHERE status <> 'processing' GROUP BY endpoint""")
def availability(spark, sf):
    return six(slo.availability(requests(spark, sf), ["endpoint"]))


@query("errors_by_type", f"""WITH {REQUESTS_SQL}
SELECT {_6H} AS window_start, error_type, count(*) AS errors, round(count(*) / 21600, 6) AS per_second
FROM requests WHERE error_type IS NOT NULL GROUP BY ALL""")
def errors_by_type(spark, sf):
    return six(slo.errors_by_type(requests(spark, sf), 21_600))


# -- objectives ----------------------------------------------------------------------------------
INDICATORS_SQL = f"""{REQUESTS_SQL}, one AS (SELECT 1 AS k, latency_seconds FROM requests),
{_buckets_sql(slo.PREDICT_BOUNDS, 'k', 'one')}, {_quantiles_sql(0.95, 'k')}, {LAG_SQL}, {MODELS_SQL}, indicators AS (
  SELECT (SELECT value FROM quantiles) AS p95_seconds,
    (SELECT count(*) FILTER (status = '200') * 100 / count(*) FROM requests WHERE status <> 'processing') AS availability,
    (SELECT CAST(sum(lag) AS BIGINT) FROM lag_rows WHERE consumer_group = 'featurizer') AS lag,
    (SELECT max(f1) FROM metrics) AS f1,
    (SELECT count(error_type) * 100 / count(*) FROM requests) AS error_rate)"""


def indicators(spark, sf):
    log = requests(spark, sf)
    p95 = slo.histogram_quantile(slo.latency_histogram(log.withColumn("k", F.lit(1)), by=["k"]), 0.95, ["k"])
    lag = slo.consumer_lag(*offsets(spark, sf)).where(F.col("consumer_group") == "featurizer").agg(F.sum("lag"))
    f1 = model_metrics(spark, sf).agg(F.max("f1"))
    return slo.availability(log).select("availability").withColumns({
        "p95_seconds": p95.select("value").scalar(), "lag": lag.scalar(), "f1": f1.scalar(),
        "error_rate": slo.error_rate(log).select("error_rate").scalar(),
    })


@query("slo_status", f"""WITH {INDICATORS_SQL}
SELECT 'latency_p95' AS objective, round(p95_seconds, 6) AS value, 0.8::DOUBLE AS target, p95_seconds <= 0.8 AS met FROM indicators
UNION ALL SELECT 'availability', round(availability, 6), 99, availability >= 99 FROM indicators
UNION ALL SELECT 'freshness', lag, 1000, lag < 1000 FROM indicators
UNION ALL SELECT 'f1', round(f1, 6), 0.75, f1 >= 0.75 FROM indicators""")
def slo_status(spark, sf):
    return six(slo.slo_status(indicators(spark, sf)))


@query("rollback_decision", f"""WITH {INDICATORS_SQL}
SELECT round(p95_seconds * 1000, 6) AS latency_ms, round(error_rate, 6) AS error_rate, round(f1, 6) AS f1,
  CASE WHEN p95_seconds * 1000 > 2000 OR error_rate > 10 THEN 'baseline' WHEN f1 < 0.7 THEN 'previous version'
    ELSE 'keep' END AS target,
  CASE WHEN p95_seconds * 1000 > 2000 OR error_rate > 10 THEN 'immediate' WHEN f1 < 0.7 THEN 'within 1 hour'
    ELSE 'none' END AS urgency FROM indicators""")
def rollback_decision(spark, sf):
    i = indicators(spark, sf).select((F.col("p95_seconds") * 1000).alias("latency_ms"), "error_rate", "f1",
                                     F.lit(0.25).alias("drift_share"))
    return six(slo.rollback_decision(i).drop("drift_share"))


_HOUR = RATE_SQL.format(us=3_600_000_000)
HOURLY_SQL = f"""{REQUESTS_SQL}, hourly AS (SELECT *, {_HOUR} AS minute FROM requests),
{_buckets_sql(slo.PREDICT_BOUNDS, 'minute', 'hourly')}, {_quantiles_sql(0.95, 'minute')}, up AS (
  SELECT minute, count(*) FILTER (status = '200') * 100 / count(*) AS success FROM hourly
  WHERE status <> 'processing' GROUP BY minute
), series AS (SELECT minute, value AS p95, success FROM quantiles FULL JOIN up USING (minute))"""


def _alerts_sql(value: str, rules, below: bool) -> str:
    op, worst = ("<", "min") if below else (">", "max")
    return " UNION ALL ".join(f"""
SELECT '{s}' AS severity, min(minute) AS first_interval, max(minute) AS last_interval, count(*) AS intervals,
  round({worst}({value}), 6) AS worst FROM (SELECT *, epoch_us(minute) // 3600000000 - row_number() OVER (ORDER BY minute)
  AS run FROM series WHERE {value} {op} {limit}) GROUP BY run HAVING count(*) >= {n}""" for s, limit, n in rules)




@query("sustained_latency_alerts", f"WITH {HOURLY_SQL} {_alerts_sql('p95', slo.LATENCY_ALERTS, False)}")
def sustained_latency_alerts(spark, sf):
    """Hours take the place of minutes."""
    series = slo.minute_indicators(requests(spark, sf), 3600)
    return six(slo.sustained_alerts(series, "p95", "minute", slo.LATENCY_ALERTS, 3600))


@query("sustained_success_alerts", f"WITH {HOURLY_SQL} {_alerts_sql('success', slo.SUCCESS_ALERTS, True)}")
def sustained_success_alerts(spark, sf):
    series = slo.minute_indicators(requests(spark, sf), 3600)
    return six(slo.sustained_alerts(series, "success", "minute", slo.SUCCESS_ALERTS, 3600, below=True))


SLIDING_SERIES_SQL = f"""{REQUESTS_SQL}, hourly AS (
  SELECT {_HOUR} + to_hours(CAST(back AS INTEGER)) AS minute, requests.* FROM requests, (SELECT unnest(range(5)) AS back)),
{_buckets_sql(slo.PREDICT_BOUNDS, 'minute', 'hourly')}, {_quantiles_sql(0.95, 'minute')}, up AS (
  SELECT minute, count(*) FILTER (status = '200') * 100 / count(*) AS success, count(error_type) * 100 / count(*) AS error_rate FROM hourly
  WHERE status <> 'processing' GROUP BY minute
), series AS (SELECT minute, value AS p95, success, error_rate FROM quantiles FULL JOIN up USING (minute))"""


def _sliding_series(spark, sf):
    """Indicators over the last five intervals, at every interval; hours take the place of minutes."""
    return slo.minute_indicators(requests(spark, sf), 3600, window=5 * 3600)


@query("sliding_indicators", f"""WITH {SLIDING_SERIES_SQL}
SELECT minute, round(p95, 6) AS p95, round(success, 6) AS success, round(error_rate, 6) AS error_rate FROM series""")
def sliding_indicators(spark, sf):
    return six(_sliding_series(spark, sf))


@query("handbook_latency_alerts", f"WITH {SLIDING_SERIES_SQL} {_alerts_sql('p95', slo.HANDBOOK_LATENCY_ALERTS, False)}")
def handbook_latency_alerts(spark, sf):
    return six(slo.sustained_alerts(_sliding_series(spark, sf), "p95", "minute", slo.HANDBOOK_LATENCY_ALERTS, 3600))


@query("handbook_error_rate_alerts", f"WITH {SLIDING_SERIES_SQL} {_alerts_sql('error_rate', slo.HANDBOOK_ERROR_RATE_ALERTS, False)}")
def handbook_error_rate_alerts(spark, sf):
    return six(slo.sustained_alerts(_sliding_series(spark, sf), "error_rate", "minute", slo.HANDBOOK_ERROR_RATE_ALERTS, 3600))


LAG_SERIES_SQL = f"""{SNAPSHOT_SQL}, series AS (SELECT poll AS minute, CAST(sum(log_end_offset - consumer_offset) AS BIGINT)
  AS lag FROM snapshots GROUP BY poll)"""


def _lag_series(spark, sf):
    return _snapshots(spark, sf).groupBy(F.col("poll").alias("minute")).agg(F.sum("lag").alias("lag"))


@query("sustained_lag_alerts", f"WITH {LAG_SERIES_SQL} " + _alerts_sql("lag", slo.LAG_ALERTS, False).replace(
    "3600000000", "86400000000").replace("round(max(lag), 6)", "max(lag)"))
def sustained_lag_alerts(spark, sf):
    """Days take the place of minutes."""
    return slo.sustained_alerts(_lag_series(spark, sf), "lag", "minute", slo.LAG_ALERTS, 86_400)


@query("handbook_lag_alerts", f"WITH {LAG_SERIES_SQL} " + _alerts_sql("lag", [("alert", 100, 10)], False).replace(
    "3600000000", "86400000000").replace("round(max(lag), 6)", "max(lag)"))
def handbook_lag_alerts(spark, sf):
    """The handbook's rule with a hundredth of its limit, for tables of this size; days take the place of minutes."""
    rules = [(severity, limit // 100, minutes) for severity, limit, minutes in slo.HANDBOOK_LAG_ALERTS]
    return slo.sustained_alerts(_lag_series(spark, sf), "lag", "minute", rules, 86_400)


@query("series_summary_lag", f"""WITH {LAG_SERIES_SQL}
SELECT round(avg(lag), 6) AS mean, max_by(lag, minute) AS last, max(lag) AS max, CASE WHEN max_by(lag, minute) < 1000
  THEN 'green' WHEN max_by(lag, minute) < 5000 THEN 'yellow' WHEN max_by(lag, minute) < 10000 THEN 'orange' ELSE 'red' END
  AS band FROM series""")
def series_summary_lag(spark, sf):
    return six(slo.series_summary(_lag_series(spark, sf), "lag", "minute", slo.LAG_BANDS, "red"))


@query("series_summary_error_rate", f"""WITH {REQUESTS_SQL}, series AS (
  SELECT {_6H} AS minute, count(error_type) * 100 / count(*) AS rate FROM requests GROUP BY 1)
SELECT round(avg(rate), 6) AS mean, round(max_by(rate, minute), 6) AS last, round(max(rate), 6) AS max,
  CASE WHEN max_by(rate, minute) < 0.5 THEN 'green' WHEN max_by(rate, minute) < 1 THEN 'yellow' ELSE 'red' END AS band
FROM series""")
def series_summary_error_rate(spark, sf):
    log = requests(spark, sf).withColumn("minute", slo.time_bucket("ts", 21_600))
    return six(slo.series_summary(slo.error_rate(log, ["minute"]), "error_rate", "minute", slo.ERROR_RATE_BANDS, "red"))


@query("error_budget", f"""WITH {REQUESTS_SQL}, d AS (
  SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (latency_seconds > 0.8) AS slow,
    count(*) FILTER (status <> '200') AS failed FROM requests WHERE status <> 'processing' GROUP BY 1
), r AS (SELECT day, sum(slow) OVER w / sum(n) OVER w * 100 AS slow_pct, sum(failed) OVER w / sum(n) OVER w * 100
  AS failed_pct FROM d WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW))
SELECT day, round(slow_pct, 6) AS slow_pct, round(failed_pct, 6) AS failed_pct,
  round(slow_pct / 5, 6) AS latency_budget_used, round(failed_pct / 1, 6) AS availability_budget_used FROM r""")
def error_budget(spark, sf):
    return six(slo.error_budget(requests(spark, sf)))


@query("series_summary", f"""WITH {HOURLY_SQL}
SELECT round(avg(p95), 6) AS mean, round(max_by(p95, minute) FILTER (p95 IS NOT NULL), 6) AS last,
  round(max(p95), 6) AS max, CASE WHEN max_by(p95, minute) FILTER (p95 IS NOT NULL) < 0.5 THEN 'green'
    WHEN max_by(p95, minute) FILTER (p95 IS NOT NULL) < 0.8 THEN 'yellow' ELSE 'red' END AS band FROM series""")
def series_summary(spark, sf):
    series = slo.minute_indicators(requests(spark, sf), 3600)
    return six(slo.series_summary(series, "p95", "minute", slo.LATENCY_BANDS, "red"))


@query("release_gate", f"""WITH {MODELS_SQL}, g AS (
  SELECT model, f1, (SELECT f1 FROM metrics WHERE position = 1) AS current_f1, 0.25 AS drift_share FROM metrics),
p AS (SELECT *, (f1 - current_f1) / current_f1 * 100 AS gain FROM g)
SELECT model, round(gain, 6) AS gain_pct, f1 > 0.4 AS f1_ok, drift_share < 0.3 AS drift_ok, gain >= 5 AS improves,
  gain >= 0 AS holds, f1 > 0.4 AND drift_share < 0.3 AND gain >= 0 AS deploy FROM p""")
def release_gate(spark, sf):
    metrics = model_metrics(spark, sf)
    current = metrics.where(F.col("model") == "z_score").select("f1").scalar()
    candidates = metrics.select("model", "f1", current.alias("current_f1"), F.lit(0.25).alias("drift_share"))
    return six(slo.release_gate(candidates, min_f1=0.4).drop("f1", "current_f1", "drift_share"))
