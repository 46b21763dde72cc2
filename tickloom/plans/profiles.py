"""Queries that profile the feature table and evaluate predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import columns as cols
from tickloom.operators import evaluation as ev, stats
from tickloom.plans.fixtures import (
    DAILY_SQL, FEATURES_SQL, REQUESTS_SQL, SCORED_SQL, daily_scores, requests, scored, stored_features, table,
)
from tickloom.session import written
from tickloom.plans.registry import query, six
from tickloom.schemas import FEATURES

LONG_SQL = f"{FEATURES_SQL}, long AS (SELECT feature, value FROM (SELECT {', '.join(FEATURES)} FROM features) " \
           "UNPIVOT (value FOR feature IN (COLUMNS(*))))"
VOLATILITY = ["volatility_30s", "volatility_60s", "volatility_120s"]


def untidy(spark, sf):
    """Events with gaps: every 13th value missing, every 17th NaN, every 19th infinite, every 23rd row doubled."""
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("value").alias("v"))
    i = F.col("event_id")
    value = F.when(i % 13 == 0, F.lit(None)).when(i % 17 == 0, F.lit(float("nan"))).when(
        i % 19 == 0, F.lit(float("inf"))).otherwise(F.col("v"))
    rows = e.select("event_id", F.when(i % 29 != 0, F.col("user_id")).alias("user_id"), value.alias("value"))
    return rows.unionByName(rows.where(i % 23 == 0))


UNTIDY_SQL = """
base AS (
  SELECT event_id, CASE WHEN event_id % 29 <> 0 THEN user_id END AS user_id,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'nan'::DOUBLE
         WHEN event_id % 19 = 0 THEN 'inf'::DOUBLE ELSE value END AS value FROM events
), untidy AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE event_id % 23 = 0)"""


# -- profiles ------------------------------------------------------------------------------------
@query("describe_features", f"""WITH {LONG_SQL}
SELECT feature, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 9) AS p25,
  round(quantile_cont(value, 0.5), 9) AS p50, round(quantile_cont(value, 0.75), 9) AS p75 FROM long GROUP BY feature""")
def describe_features(spark, sf):
    return six(stats.describe_features(stored_features(spark, sf), FEATURES), nine=("p25", "p50", "p75"))


@query("extended_stats", f"""WITH {LONG_SQL}
SELECT feature, round(avg(value), 6) AS mean, round(median(value), 9) AS median, round(stddev_samp(value), 6) AS std,
  min(value) AS min, max(value) AS max, round(skewness(value), 6) AS skewness,
  round(kurtosis(value), 6) AS kurtosis, 0::BIGINT AS missing, 0.0::DOUBLE AS missing_pct FROM long GROUP BY feature""")
def extended_stats(spark, sf):
    return six(stats.extended_stats(stored_features(spark, sf), FEATURES), nine=("median",))


@query("missing_values", f"""WITH {UNTIDY_SQL}, counted AS (
  SELECT count(*) AS n, count(*) FILTER (event_id IS NULL) AS a, count(*) FILTER (user_id IS NULL) AS b,
         count(*) FILTER (value IS NULL OR isnan(value)) AS c FROM untidy)
SELECT 'event_id' AS feature, a AS missing, round(a / n * 100, 6) AS missing_pct FROM counted
UNION ALL SELECT 'user_id', b, round(b / n * 100, 6) FROM counted
UNION ALL SELECT 'value', c, round(c / n * 100, 6) FROM counted""")
def missing_values(spark, sf):
    return six(stats.missing_values(untidy(spark, sf), ["event_id", "user_id", "value"]))


@query("duplicate_rows", f"""WITH {UNTIDY_SQL}, d AS (SELECT event_id, user_id, value, count(*) AS c FROM untidy GROUP BY ALL)
SELECT CAST(sum(c) AS BIGINT) AS rows, CAST(sum(c - 1) AS BIGINT) AS duplicates,
  round(sum(c - 1) / sum(c) * 100, 6) AS duplicate_pct FROM d""")
def duplicate_rows(spark, sf):
    return six(stats.duplicate_rows(untidy(spark, sf)))


@query("infinite_values", f"""WITH {UNTIDY_SQL}, counted AS (
  SELECT count(*) AS n, count(*) FILTER (isinf(value)) AS c FROM untidy)
SELECT 'value' AS feature, c AS infinite, round(c / n * 100, 6) AS infinite_pct FROM counted
UNION ALL SELECT 'user_id', 0, 0.0 FROM counted""")
def infinite_values(spark, sf):
    return six(stats.infinite_values(untidy(spark, sf), ["value", "user_id"]))


@query("distinct_counts", f"""WITH {LONG_SQL}
SELECT feature, CAST(count(*) FILTER (value <> 0) AS BIGINT) AS non_zero, min(value) AS min, max(value) AS max,
  round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, count(DISTINCT value) AS distinct_values
FROM long WHERE feature LIKE 'return%' GROUP BY feature""")
def distinct_counts(spark, sf):
    names = ["return_10s", "return_30s", "return_60s"]
    return six(stats.distinct_counts(stored_features(spark, sf, columns=names), names))


@query("distinct_counts_merged", f"""WITH {LONG_SQL}
SELECT feature, count(DISTINCT value) AS exact, count(value) AS known, true AS close, true AS same_merged_twice
FROM long WHERE feature LIKE 'return%' GROUP BY feature""")
def distinct_counts_merged(spark, sf):
    """Sketches per day, stored and merged: the estimate lies within four deviations of the exact count, however days are merged."""
    names = ["return_10s", "return_30s", "return_60s"]
    rows = stored_features(spark, sf, columns=names)
    daily = written(stats.distinct_sketches(rows.withColumn("day", F.to_date("ts")), names, ["day"]), "sketches")
    once = stats.merged_distinct(daily)
    monthly = stats.merged_distinct(daily.withColumn("month", F.trunc("day", "month")), ["month"])
    twice = stats.merged_distinct(monthly).select("feature", F.col("distinct_values").alias("again"))
    exact = stats.distinct_counts(rows, names).select("feature", F.col("distinct_values").alias("exact"))
    off = F.abs(F.col("distinct_values") - F.col("exact"))
    return once.join(exact, "feature").join(twice, "feature").select(
        "feature", "exact", "known", (off <= 1 + F.col("exact") * 4 * 1.04 / 64).alias("close"), (F.col("distinct_values") == F.col("again")).alias("same_merged_twice"))


@query("timestamp_uniqueness", """WITH per_time AS (
  SELECT epoch_us(ts) // 600000000 AS slot, count(*) AS size FROM events GROUP BY 1
), usual AS (SELECT size FROM per_time GROUP BY size ORDER BY count(*) DESC, size LIMIT 1)
SELECT CAST(sum(size) AS BIGINT) AS rows, count(*) AS unique_times,
  round((1 - count(*) / sum(size)) * 100, 6) AS duplicate_pct, (SELECT size FROM usual) AS usual_size,
  max(size) AS largest_size, count(*) FILTER (size > 1) AS repeated_times,
  round(count(*) FILTER (size > 1) / count(*) * 100, 6) AS repeated_pct FROM per_time""")
def timestamp_uniqueness(spark, sf):
    slot = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 600_000_000)
    return six(stats.timestamp_uniqueness(table(spark, sf, "events").select(slot.alias("slot")), "slot"))


@query("gap_stats", """WITH d AS (
  SELECT (epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts, event_id)) / 1e6::DOUBLE AS g FROM events)
SELECT round(avg(g), 6) AS mean_gap, min(g) AS min_gap, max(g) AS max_gap, round(stddev_samp(g), 6) AS std_gap,
  count(*) FILTER (g > 60) AS long_gaps, round(median(g), 6) AS median_gap, round(1 / median(g), 6) AS rows_per_second,
  round(10 / median(g), 6) AS expected_10s, round(30 / median(g), 6) AS expected_30s,
  round(60 / median(g), 6) AS expected_60s FROM d WHERE g IS NOT NULL""")
def gap_stats(spark, sf):
    return six(stats.gap_stats(table(spark, sf, "events"), "ts", "event_id"))


@query("continuous_periods", """WITH d AS (
  SELECT row_number() OVER w - 1 AS i, (epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6 AS gap,
         (max(epoch_us(ts)) OVER () - epoch_us(ts)) / 1e6 AS left_over FROM events WINDOW w AS (ORDER BY ts, event_id))
SELECT CAST(count(*) > 0 AS INTEGER) AS continuous_periods, coalesce(min(i), -1) AS first_index
FROM d WHERE gap < 10 AND left_over >= 60""")
def continuous_periods(spark, sf):
    return stats.continuous_period(table(spark, sf, "events"), "ts", "event_id")


@query("percentile_curve", f"""WITH {LONG_SQL}
SELECT feature, {', '.join(f"round(quantile_cont(value, {p / 100}), 9) AS p{p}" for p in (10, 25, 50, 75, 90, 95, 99))}
FROM long WHERE feature LIKE 'volatility%' GROUP BY feature""")
def percentile_curve(spark, sf):
    curve = stats.percentile_curve(stored_features(spark, sf, columns=VOLATILITY), VOLATILITY)
    return six(curve, nine=tuple(curve.columns))


@query("threshold_analysis", f"""WITH {FEATURES_SQL}, q AS (
  SELECT quantile_cont(volatility_60s, [0.9, 0.95, 0.99]) AS t, count(*) AS n FROM features
), cuts AS (SELECT unnest([90, 95, 99]) AS percentile, unnest(t) AS threshold, n FROM q), above AS (
  SELECT percentile, threshold, n, (SELECT count(*) FROM features WHERE volatility_60s > threshold) AS spikes FROM cuts)
SELECT percentile, round(threshold, 9) AS threshold, spikes, round(spikes / n * 100, 6) AS spike_rate FROM above""")
def threshold_analysis(spark, sf):
    return six(stats.threshold_analysis(stored_features(spark, sf, columns=["volatility_60s"]), "volatility_60s"),
               nine=("threshold",))


@query("iqr_outliers", f"""WITH {LONG_SQL}, q AS (
  SELECT feature, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM long GROUP BY feature), b AS (SELECT feature, n, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT feature, count(*) AS outliers, round(count(*) / any_value(n) * 100, 6) AS outlier_pct,
  round(any_value(lo), 9) AS lower_bound, round(any_value(hi), 9) AS upper_bound
FROM long JOIN b USING (feature) WHERE value < lo OR value > hi GROUP BY feature""")
def iqr_outliers(spark, sf):
    return six(stats.iqr_outliers(stored_features(spark, sf), FEATURES), nine=("lower_bound", "upper_bound"))


@query("zscore_outliers", f"""WITH {LONG_SQL}, m AS (
  SELECT feature, count(*) AS n, avg(value) AS mu, stddev_pop(value) AS sd FROM long GROUP BY feature)
SELECT feature, count(*) AS outliers, round(count(*) / any_value(n) * 100, 6) AS outlier_pct
FROM long JOIN m USING (feature) WHERE sd > 0 AND abs(value - mu) / sd > 3 GROUP BY feature""")
def zscore_outliers(spark, sf):
    return six(stats.zscore_outliers(stored_features(spark, sf), FEATURES))


_PAIRS = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]]
CORRELATION_SQL = f"{FEATURES_SQL}, correlations AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM features"
    for a, b in _PAIRS) + ")"


@query("correlation_matrix", f"WITH {CORRELATION_SQL} SELECT * FROM correlations")
def correlation_matrix(spark, sf):
    return six(stats.correlation_matrix(stored_features(spark, sf), FEATURES))


@query("strong_correlations", f"WITH {CORRELATION_SQL} SELECT * FROM correlations WHERE abs(correlation) > 0.7")
def strong_correlations(spark, sf):
    return six(stats.strong_correlations(stored_features(spark, sf), FEATURES))


HISTOGRAM_SQL = """e AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n FROM known),
f AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END AS span, n FROM e WHERE n > 0),
c AS (SELECT CAST(least(floor((value - lo) / span * 50), 49) AS INTEGER) AS bin, count(*) AS count FROM known, f GROUP BY 1),
bins AS (SELECT CAST(unnest(range(50)) AS INTEGER) AS bin)
SELECT bin, round(lo + bin * (span / 50), 6) AS lower, coalesce(count, 0) AS count,
  round(coalesce(count, 0) / n / (span / 50), 6) AS density FROM bins CROSS JOIN f LEFT JOIN c USING (bin)"""


@query("histogram", f"WITH known AS (SELECT value FROM events), {HISTOGRAM_SQL}")
def histogram(spark, sf):
    return six(stats.histogram(table(spark, sf, "events"), "value"))


#: Skewed values with NULL, NaN and infinite ones: most of the fifty bins are empty.
SKEWED = "CASE WHEN event_id % 10 = 0 THEN 'nan'::DOUBLE WHEN event_id % 10 = 1 THEN NULL WHEN event_id % 997 = 5 THEN 'inf'::DOUBLE ELSE value * value * value END"


def skewed(spark, sf):
    e, v = F.col("event_id"), F.col("value")
    value = F.when(e % 10 == 0, F.lit(float("nan"))).when(e % 10 == 1, F.lit(None)).when(e % 997 == 5, F.lit(float("inf"))).otherwise(v * v * v)
    return table(spark, sf, "events").select(value.alias("value"))


@query("histogram_with_gaps", f"""WITH known AS (
  SELECT * FROM (SELECT {SKEWED} AS value FROM events) WHERE value IS NOT NULL AND isfinite(value)), {HISTOGRAM_SQL}""")
def histogram_with_gaps(spark, sf):
    return six(stats.histogram(skewed(spark, sf), "value"))


@query("threshold_analysis_with_gaps", f"""WITH known AS (
  SELECT * FROM (SELECT {SKEWED} AS value FROM events) WHERE value IS NOT NULL AND NOT isnan(value)
), q AS (SELECT quantile_cont(value, [0.5, 0.9, 0.95]) AS t, count(*) AS n FROM known),
cuts AS (SELECT unnest([50, 90, 95]) AS percentile, unnest(t) AS threshold, n FROM q),
above AS (SELECT percentile, threshold, n, (SELECT count(*) FROM known WHERE value > threshold) AS spikes FROM cuts)
SELECT percentile, round(threshold, 3) AS threshold, spikes, round(spikes / n * 100, 6) AS spike_rate FROM above""")
def threshold_analysis_with_gaps(spark, sf):
    found = stats.threshold_analysis(skewed(spark, sf), "value", (50, 90, 95))
    return six(found.withColumn("threshold", F.round("threshold", 3)), "spike_rate")


@query("value_counts", """SELECT CAST(value > 50 AS INTEGER) AS volatility_spike, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM events) * 100, 6) AS share_pct FROM events GROUP BY 1""")
def value_counts(spark, sf):
    labelled = table(spark, sf, "events").select((F.col("value") > 50).cast("int").alias("volatility_spike"))
    return six(stats.value_counts(labelled, "volatility_spike"))


@query("time_range", """SELECT min(ts) AS first_ts, max(ts) AS last_ts, round((epoch_us(max(ts)) - epoch_us(min(ts)))
  / 1e6::DOUBLE, 6) AS seconds, count(*) AS rows FROM events""")
def time_range(spark, sf):
    return six(stats.time_range(table(spark, sf, "events"), "ts"))


# -- evaluation ----------------------------------------------------------------------------------
CONFUSION_SQL = f"""{SCORED_SQL}, c AS (
  SELECT count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
         count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp
  FROM scored)"""


@query("align_predictions", f"WITH {SCORED_SQL} SELECT * FROM scored")
def align_predictions(spark, sf):
    return scored(spark, sf)


@query("confusion_matrix", f"WITH {CONFUSION_SQL} SELECT * FROM c")
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(scored(spark, sf))


@query("classification_metrics", f"""WITH {CONFUSION_SQL}
SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6)
  AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def classification_metrics(spark, sf):
    return six(ev.classification_metrics(scored(spark, sf)))


@query("classification_report", f"""WITH {CONFUSION_SQL}, s AS (
  SELECT coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
    coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0, tn + fp AS n0, coalesce(tp / nullif(tp + fp, 0), 0) AS p1,
    coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, tp + fn AS n1,
    (tp + tn) / (tp + tn + fp + fn) AS acc FROM c), rows AS (
  SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, n0 AS support FROM s
  UNION ALL SELECT '1', p1, r1, f1, n1 FROM s
  UNION ALL SELECT 'accuracy', acc, acc, acc, n0 + n1 FROM s
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM s
  UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1),
    (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM s)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rows""")
def classification_report(spark, sf):
    return six(ev.classification_report(scored(spark, sf)))


BY_SCORE_SQL = f"""{SCORED_SQL}, per_score AS (
  SELECT score, sum(y_true) AS pos, count(*) - sum(y_true) AS neg FROM scored GROUP BY score
), running AS (
  SELECT *, sum(pos) OVER up AS up_pos, sum(neg) OVER up AS up_neg, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp,
         sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
  FROM per_score WINDOW up AS (ORDER BY score), down AS (ORDER BY score DESC))"""


@query("roc_auc", f"""WITH {BY_SCORE_SQL}
SELECT round(sum(pos * (up_neg - neg / 2)) / (max(all_pos) * max(all_neg)), 6) AS roc_auc FROM running""")
def roc_auc(spark, sf):
    return six(ev.roc_auc(scored(spark, sf)))


@query("average_precision", f"""WITH {BY_SCORE_SQL}
SELECT round(sum(pos / all_pos * (tp / (tp + fp))), 6) AS average_precision FROM running""")
def average_precision(spark, sf):
    return six(ev.average_precision(scored(spark, sf)))


@query("pr_curve", f"""WITH {BY_SCORE_SQL}
SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / all_pos, 6) AS recall,
  round(all_pos / (all_pos + all_neg), 6) AS base_rate FROM running
UNION ALL SELECT NULL, 1.0, 0.0, round(avg(y_true), 6) FROM scored""")
def pr_curve(spark, sf):
    return six(ev.pr_curve(scored(spark, sf)))


# three cut-offs on the score stand in for three models
CUTOFFS = {"z_score": 3000, "logistic_regression": 2000, "random_forest": 1000}


def model_metrics(spark, sf):
    s = scored(spark, sf).select("y_true", "score", F.inline(F.array(*(
        F.struct(F.lit(m).alias("model"), F.lit(float(c)).alias("cut")) for m, c in CUTOFFS.items()))))
    return ev.classification_metrics(s.withColumn("y_pred", (F.col("score") > F.col("cut")).cast("int")), ["model"])


MODELS_SQL = f"""{SCORED_SQL}, models(model, cut, position) AS (
  VALUES ('z_score', 3000, 1), ('logistic_regression', 2000, 2), ('random_forest', 1000, 3)
), cells AS (
  SELECT model, position, count(*) FILTER (y_true = 0 AND score <= cut) AS tn,
    count(*) FILTER (y_true = 0 AND score > cut) AS fp, count(*) FILTER (y_true = 1 AND score <= cut) AS fn,
    count(*) FILTER (y_true = 1 AND score > cut) AS tp FROM scored, models GROUP BY ALL
), metrics AS (
  SELECT model, position, (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM cells)"""


@query("compare_models", f"""WITH {MODELS_SQL}, changed AS (
  SELECT *, (f1 - lag(f1) OVER (ORDER BY position)) / lag(f1) OVER (ORDER BY position) * 100 AS change_pct FROM metrics)
SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, round(change_pct, 6) AS change_pct,
  model = (SELECT model FROM metrics ORDER BY f1 DESC, position LIMIT 1) AS is_best,
  CASE WHEN change_pct IS NULL THEN 'baseline' WHEN abs(change_pct) < 1 THEN 'keep simpler model'
       WHEN change_pct > 5 THEN 'use this model' WHEN change_pct > 0 THEN 'marginal' ELSE 'keep simpler model' END
  AS advice FROM changed""")
def compare_models(spark, sf):
    return six(ev.compare_models(model_metrics(spark, sf), "f1", list(CUTOFFS)))


@query("best_model", f"""WITH {MODELS_SQL}
SELECT model, round(f1, 6) AS f1 FROM metrics ORDER BY f1 DESC LIMIT 1""")
def best_model(spark, sf):
    return six(ev.best_model(model_metrics(spark, sf), "f1"))


@query("pr_auc_rating", f"""WITH {BY_SCORE_SQL}, a AS (SELECT sum(pos / all_pos * (tp / (tp + fp))) AS ap FROM running)
SELECT round(ap, 6) AS pr_auc, CASE WHEN ap > 0.95 THEN 'Outstanding' WHEN ap > 0.8 THEN 'Excellent'
  WHEN ap > 0.6 THEN 'Good' WHEN ap > 0.3 THEN 'Moderate' ELSE 'Poor' END AS rating FROM a""")
def pr_auc_rating(spark, sf):
    ap = ev.average_precision(scored(spark, sf)).withColumnRenamed("average_precision", "pr_auc")
    return six(ap.withColumn("rating", cols.pr_auc_rating(F.col("pr_auc"))))


# -- prediction and request logs -----------------------------------------------------------------
@query("prediction_distribution", f"""WITH {REQUESTS_SQL}, c AS (
  SELECT CASE WHEN prediction = 1 THEN 'spike' ELSE 'normal' END AS class_label, model_version, count(*) AS predictions
  FROM requests WHERE prediction IS NOT NULL GROUP BY ALL)
SELECT *, round(sum(CASE WHEN class_label = 'spike' THEN predictions ELSE 0 END) OVER (PARTITION BY model_version)
  / sum(predictions) OVER (PARTITION BY model_version), 6) AS spike_share FROM c""")
def prediction_distribution(spark, sf):
    return six(ev.prediction_distribution(requests(spark, sf)))


@query("confidence_histogram", f"""WITH {REQUESTS_SQL}, bounds AS (
  SELECT unnest([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0, 'inf'::DOUBLE]) AS le)
SELECT CASE WHEN prediction = 1 THEN 'spike' ELSE 'normal' END AS class_label, le,
  count(*) FILTER (probability <= le) AS cumulative
FROM requests, bounds WHERE prediction IS NOT NULL GROUP BY ALL""")
def confidence_histogram(spark, sf):
    return ev.confidence_histogram(requests(spark, sf))


@query("class_label", f"""WITH {REQUESTS_SQL}
SELECT request_id, CASE WHEN prediction = 1 THEN 'spike' ELSE 'normal' END AS class_label,
  round(probability, 4) AS probability FROM requests WHERE prediction IS NOT NULL""")
def class_label(spark, sf):
    log = requests(spark, sf).where(F.col("prediction").isNotNull())
    return log.select("request_id", cols.class_label(F.col("prediction")).alias("class_label"),
                      F.round("probability", 4).alias("probability"))


@query("error_breakdown", f"""WITH {REQUESTS_SQL}
SELECT error_type, count(*) AS errors FROM requests WHERE error_type IS NOT NULL GROUP BY ALL""")
def error_breakdown(spark, sf):
    return ev.error_breakdown(requests(spark, sf))


LATENCY_SQL = f"""{REQUESTS_SQL}, good AS (
  SELECT round(latency_seconds * 1000, 6) AS ms, row_number() OVER (ORDER BY latency_seconds) - 1 AS i, count(*) OVER () AS n
  FROM requests WHERE status = '200'
), base AS (
  SELECT count(*) AS total_requests, count(*) FILTER (status = '200') AS successful_requests,
    count(*) FILTER (status <> '200') AS failed_requests,
    (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM requests
), g AS (
  SELECT min(ms) AS min_ms, max(ms) AS max_ms, avg(ms) AS mean_ms, stddev_samp(ms) AS std_ms, median(ms) AS median_ms,
    max(CASE WHEN i = least(n * 50 // 100, n - 1) THEN ms END) AS p50_ms,
    max(CASE WHEN i = least(n * 95 // 100, n - 1) THEN ms END) AS p95_ms,
    max(CASE WHEN i = least(n * 99 // 100, n - 1) THEN ms END) AS p99_ms FROM good)"""


@query("latency_report", f"""WITH {LATENCY_SQL}
SELECT total_requests, successful_requests, failed_requests,
  round(successful_requests * 100 / total_requests, 6) AS success_rate,
  round(total_requests / seconds, 6) AS requests_per_second, round(min_ms, 6) AS min_ms, round(max_ms, 6) AS max_ms,
  round(mean_ms, 6) AS mean_ms, round(std_ms, 6) AS std_ms, round(median_ms, 6) AS median_ms, p50_ms, p95_ms, p99_ms,
  p95_ms <= 100 AS p95_ok, successful_requests * 100 / total_requests >= 99 AS success_ok FROM base, g""")
def latency_report(spark, sf):
    return six(ev.latency_report(requests(spark, sf), F.col("status") == "200"))


@query("latency_assessment", f"""WITH {LATENCY_SQL}
SELECT p95_ms, CASE WHEN p95_ms < 50 THEN 'EXCELLENT' WHEN p95_ms < 100 THEN 'GOOD' WHEN p95_ms < 200 THEN 'ACCEPTABLE'
  ELSE 'NEEDS IMPROVEMENT' END AS assessment FROM g""")
def latency_assessment(spark, sf):
    report = ev.latency_report(requests(spark, sf), F.col("status") == "200")
    return six(report.select("p95_ms", cols.latency_assessment(F.col("p95_ms")).alias("assessment")))


@query("daily_metrics", f"""WITH {DAILY_SQL}, c AS (
  SELECT day, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
    count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, count(*) AS n,
    count(*) FILTER (y_true = y_pred) AS hit FROM daily GROUP BY day)
SELECT day, round(hit / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def daily_metrics(spark, sf):
    return six(ev.classification_metrics(daily_scores(spark, sf), ["day"]))
