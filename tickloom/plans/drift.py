"""Queries on drift, data quality and retraining."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import columns as cols
from tickloom.operators import drift, models
from tickloom.plans.fixtures import (
    DAILY_SQL, DRIFT_COLUMNS, DRIFT_SQL, FEATURES_SQL, daily_scores, drift_pair, stored_features, table,
)
from tickloom.plans.profiles import MODELS_SQL, model_metrics
from tickloom.plans.registry import query, six
from tickloom.session import scratch_dir, written

_LIST = ", ".join(DRIFT_COLUMNS)
BOTH_SQL = f"""{DRIFT_SQL}, long AS (
  SELECT 'reference' AS side, feature, value FROM (SELECT {_LIST} FROM reference) UNPIVOT (value FOR feature IN ({_LIST}))
  UNION ALL
  SELECT 'current', feature, value FROM (SELECT {_LIST} FROM current_rows) UNPIVOT (value FOR feature IN ({_LIST})))"""

CDF_SQL = f"""{BOTH_SQL}, per_value AS (
  SELECT feature, value, count(*) FILTER (side = 'reference') AS ref, count(*) FILTER (side = 'current') AS cur
  FROM long GROUP BY feature, value
), cdf AS (
  SELECT *, sum(ref) OVER w / sum(ref) OVER (PARTITION BY feature) AS f_ref,
    sum(cur) OVER w / sum(cur) OVER (PARTITION BY feature) AS f_cur,
    sum(ref) OVER (PARTITION BY feature) AS n, sum(cur) OVER (PARTITION BY feature) AS m,
    lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value
  FROM per_value WINDOW w AS (PARTITION BY feature ORDER BY value)
), d AS (
  SELECT feature, max(abs(f_ref - f_cur)) AS statistic, max(n) AS n, max(m) AS m FROM cdf GROUP BY feature
), l AS (SELECT *, statistic * sqrt(n::DOUBLE * m / (n + m)) AS s FROM d
), ks AS (
  SELECT feature, statistic, CASE WHEN s < 0.2 THEN 1.0 ELSE greatest(least(list_sum(list_transform(range(1, 101),
    lambda i: CASE WHEN i % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * i * i * s * s))), 1.0), 0.0) END AS p_value FROM l)"""


@query("ks_test", f"""WITH {CDF_SQL}
SELECT feature, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted FROM ks""")
def ks_test(spark, sf):
    return six(drift.ks_test(*drift_pair(spark, sf), DRIFT_COLUMNS))


@query("wasserstein", f"""WITH {CDF_SQL}, w AS (
  SELECT feature, sum(abs(f_ref - f_cur) * (next_value - value)) AS distance FROM cdf GROUP BY feature
), s AS (SELECT feature, stddev_samp(value) AS sd FROM long WHERE side = 'reference' GROUP BY feature)
SELECT feature, round(distance, 6) AS distance, round(distance / sd, 6) AS normed_distance, distance / sd >= 0.1 AS drifted FROM w JOIN s USING (feature)""")
def wasserstein(spark, sf):
    return six(drift.wasserstein(*drift_pair(spark, sf), DRIFT_COLUMNS))


CHI_CELLS_SQL = """cells AS (
  SELECT v, count(*) FILTER (s = 'r')::DOUBLE AS ref, count(*) FILTER (s = 'c')::DOUBLE AS cur FROM (
    SELECT l_returnflag AS v, 'r' AS s FROM reference UNION ALL SELECT l_returnflag, 'c' FROM current_rows) GROUP BY v
), totals AS (SELECT *, sum(ref) OVER () AS r, sum(cur) OVER () AS c FROM cells), expected AS (
  SELECT *, (ref + cur) * r / (r + c) AS er, (ref + cur) * c / (r + c) AS ec FROM totals
), chi AS (SELECT sum((ref - er) ^ 2 / er + (cur - ec) ^ 2 / ec) AS statistic, count(*) - 1 AS dof FROM expected)"""
CHI_SQL = f"{DRIFT_SQL}, {CHI_CELLS_SQL}"


@query("chi_square_drift", f"""WITH {CHI_SQL}
SELECT 'l_returnflag' AS feature, round(statistic, 6) AS statistic, dof, round(exp(-statistic / 2), 6) AS p_value,
  exp(-statistic / 2) < 0.05 AS drifted FROM chi""")
def chi_square_drift(spark, sf):
    """Three flags give two degrees of freedom, for which the tail is exp(-x / 2)."""
    return six(drift.chi_square_drift(*drift_pair(spark, sf), "l_returnflag"))


DATASET_SQL = f"""{CDF_SQL}, flags AS (SELECT feature, p_value, p_value < 0.05 AS drifted FROM ks), whole AS (
  SELECT count(*) FILTER (drifted) AS number_of_drifted_features,
    avg(CAST(drifted AS INTEGER)) AS share_of_drifted_features, avg(CAST(drifted AS INTEGER)) >= 0.2 AS
    dataset_drift_detected, coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (drifted), '') AS drifted_features
  FROM flags)"""


def _dataset(spark, sf):
    # one of four columns is made to drift: a share of 0.25
    return drift.dataset_drift(drift.ks_test(*drift_pair(spark, sf), DRIFT_COLUMNS), share_limit=0.2)


@query("dataset_drift", f"""WITH {DATASET_SQL}
SELECT number_of_drifted_features, round(share_of_drifted_features, 6) AS share_of_drifted_features,
  dataset_drift_detected, drifted_features FROM whole""")
def dataset_drift(spark, sf):
    return six(_dataset(spark, sf).withColumn("drifted_features", F.array_join("drifted_features", ",")).drop(
        "drift_by_feature"))


#: The categorical column takes part: with l_quantity by distance and l_returnflag by chi-square, the flag decides.
MIXED_SQL = f"""{CDF_SQL}, {CHI_CELLS_SQL}, tested AS (
  SELECT feature, round(p_value, 6) AS drift_score, 'ks' AS stattest_name, p_value < 0.05 AS drifted FROM ks WHERE feature = 'l_quantity'
  UNION ALL SELECT 'l_returnflag', round(exp(-statistic / 2), 6), 'chisquare', exp(-statistic / 2) < 0.05 FROM chi)"""


def _mixed(spark, sf):
    return drift.column_tests(*drift_pair(spark, sf), {"l_quantity": "ks", "l_returnflag": "chisquare"})


@query("dataset_drift_mixed", f"""WITH {MIXED_SQL}
SELECT count(*) FILTER (drifted) AS number_of_drifted_features, avg(CAST(drifted AS INTEGER)) AS share_of_drifted_features,
  avg(CAST(drifted AS INTEGER)) >= 0.5 AS dataset_drift_detected, coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (drifted), '')
  AS drifted_features FROM tested""")
def dataset_drift_mixed(spark, sf):
    found = drift.dataset_drift(_mixed(spark, sf), share_limit=0.5)
    return found.withColumn("drifted_features", F.array_join("drifted_features", ",")).drop("drift_by_feature")


@query("column_tests", f"WITH {MIXED_SQL} SELECT feature, drift_score, stattest_name, 0.05::DOUBLE AS threshold, drifted FROM tested")
def column_tests(spark, sf):
    return six(_mixed(spark, sf), "drift_score")


@query("logged_drift_runs", f"""WITH {MIXED_SQL}
SELECT feature, run, drift_score AS score, stattest_name, drifted FROM tested, (SELECT unnest([2, 3]) AS run)""")
def logged_drift_runs(spark, sf):
    """Three runs are appended to the log; the last two of each feature are kept."""
    path, tests = scratch_dir(spark, "drift-log"), written(_mixed(spark, sf), "drift-tests")
    for run in (1, 2, 3):
        drift.log_drift_run(tests, F.timestamp_seconds(F.lit(run)), path)
    kept = drift.keep_latest_scores(spark.read.parquet(path), keep=2)
    return six(kept.select("feature", F.unix_seconds("run_at").cast("int").alias("run"), "score", "stattest_name", "drifted"), "score")


@query("drift_by_feature", f"""WITH {CDF_SQL}
SELECT feature, round(p_value, 6) AS drift_score, 'ks' AS stattest_name FROM ks WHERE p_value < 0.05""")
def drift_by_feature(spark, sf):
    """The map of drifted features, as rows."""
    return six(_dataset(spark, sf).select(F.explode("drift_by_feature").alias("feature", "detail")).select(
        "feature", "detail.*"))


@query("drift_severity", f"""WITH {DATASET_SQL}, graded AS (SELECT CASE WHEN NOT dataset_drift_detected THEN 'INFO'
  WHEN number_of_drifted_features >= 5 THEN 'CRITICAL' WHEN number_of_drifted_features >= 3 THEN 'WARNING' ELSE 'INFO'
  END AS severity FROM whole)
SELECT severity, CAST(CASE severity WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END AS INTEGER) AS exit_code
FROM graded""")
def drift_severity(spark, sf):
    graded = _dataset(spark, sf).select(
        drift.drift_severity(F.col("number_of_drifted_features"), F.col("dataset_drift_detected")).alias("severity"))
    return graded.withColumn("exit_code", drift.severity_exit_code(F.col("severity")))


@query("drift_score_band", f"""WITH {CDF_SQL}
SELECT feature, CASE WHEN statistic * 10 < 0.3 THEN 'none' WHEN statistic * 10 < 0.5 THEN 'minor'
  WHEN statistic * 10 < 0.7 THEN 'moderate' ELSE 'high' END AS band FROM ks""")
def drift_score_band(spark, sf):
    tests = drift.ks_test(*drift_pair(spark, sf), DRIFT_COLUMNS)
    return tests.select("feature", cols.drift_score_band(F.col("statistic") * 10).alias("band"))


@query("drift_share_action", f"""WITH {DATASET_SQL}
SELECT CASE WHEN share_of_drifted_features < 0.3 THEN 'schedule' WHEN share_of_drifted_features <= 0.5 THEN 'accelerate'
  ELSE 'rollback' END AS action FROM whole""")
def drift_share_action(spark, sf):
    return _dataset(spark, sf).select(cols.drift_share_action(F.col("share_of_drifted_features")).alias("action"))


@query("mean_shift", f"""WITH {BOTH_SQL}
SELECT feature, round(avg(value) FILTER (side = 'reference'), 6) AS mean_ref,
  round(avg(value) FILTER (side = 'current'), 6) AS mean_cur,
  round((avg(value) FILTER (side = 'current') / avg(value) FILTER (side = 'reference') - 1) * 100, 6) AS shift_pct
FROM long GROUP BY feature""")
def mean_shift(spark, sf):
    return six(drift.mean_shift(*drift_pair(spark, sf), DRIFT_COLUMNS))


def _pair_sql() -> str:
    parts = []
    for side, short in (("reference", "ref"), ("current", "cur")):
        on = f"FILTER (side = '{side}')"
        parts.append(f"count(value) {on} AS n_{short}, round(avg(value) {on}, 6) AS mean_{short}, "
                     f"round(stddev_samp(value) {on}, 6) AS std_{short}, round(min(value) {on}, 6) AS min_{short}, "
                     f"round(max(value) {on}, 6) AS max_{short}")
    return ", ".join(parts)


@query("two_sample_pairing", f"WITH {BOTH_SQL} SELECT feature, {_pair_sql()} FROM long GROUP BY feature")
def two_sample_pairing(spark, sf):
    return six(drift.two_sample_pairing(*drift_pair(spark, sf), DRIFT_COLUMNS))


@query("reference_current_union", f"""WITH {DRIFT_SQL}
SELECT side, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM (
  SELECT 'reference' AS side, l_quantity FROM reference UNION ALL SELECT 'current', l_quantity FROM current_rows)
GROUP BY side""")
def reference_current_union(spark, sf):
    both = drift.both_sides(*drift_pair(spark, sf), ["l_quantity"])
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("correlation_shift", f"""WITH {DRIFT_SQL}, r AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, (SELECT corr({a}, {b}) FROM reference) AS x, "
    f"(SELECT corr({a}, {b}) FROM current_rows) AS y"
    for i, a in enumerate(DRIFT_COLUMNS) for b in DRIFT_COLUMNS[i + 1:]) + """)
SELECT feature_a, feature_b, round(x, 6) AS correlation_ref, round(y, 6) AS correlation_cur, round(y - x, 6) AS shift
FROM r""")
def correlation_shift(spark, sf):
    return six(drift.correlation_shift(*drift_pair(spark, sf), DRIFT_COLUMNS))


@query("missing_shift", f"""WITH {DRIFT_SQL}, r AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT count(*) FROM reference WHERE {e}) AS x, "
    f"(SELECT count(*) FROM current_rows WHERE {e}) AS y"
    for c, e in (("l_tax", "l_tax > 0.07"), ("l_discount", "l_discount IS NULL"))) + """)
SELECT feature, x AS missing_ref, y AS missing_cur, y - x AS shift FROM r""")
def missing_shift(spark, sf):
    """Taxes above 7 % count as missing here, as the lines themselves have no gaps."""
    old, new = (d.withColumn("l_tax", F.when(F.col("l_tax") <= 0.07, F.col("l_tax"))) for d in drift_pair(spark, sf))
    return drift.missing_shift(old, new, ["l_tax", "l_discount"])


@query("quality_summary", f"""WITH {BOTH_SQL}, times AS (
  SELECT side, feature, value, count(*) AS n FROM long GROUP BY ALL
), usual AS (SELECT side, feature, value AS most_common FROM times
  QUALIFY row_number() OVER (PARTITION BY side, feature ORDER BY n DESC, value) = 1)
SELECT side, feature, count(*) AS rows, round(min(value), 6) AS min, round(max(value), 6) AS max,
  round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, count(DISTINCT value) AS distinct_values,
  round(any_value(most_common), 6) AS most_common,
  round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.75), 6) AS p75, 0::BIGINT AS missing
FROM long JOIN usual USING (side, feature) GROUP BY side, feature""")
def quality_summary(spark, sf):
    return six(drift.quality_summary(*drift_pair(spark, sf), DRIFT_COLUMNS))


@query("quality_gates", """WITH h AS (SELECT epoch_us(ts) // 3600000000 AS hour, count(*) AS n FROM events GROUP BY 1),
span AS (SELECT unnest(range((SELECT min(hour) FROM h), (SELECT max(hour) FROM h) + 1)) AS hour),
filled AS (SELECT coalesce(n, 0) AS n FROM span LEFT JOIN h USING (hour)),
d AS (SELECT user_id, event_type, epoch_us(ts) // 1000000 AS s, count(*) AS n FROM events GROUP BY ALL),
m AS (SELECT count(*) FILTER (value > 400) / (count(*) * 2) AS missing_rate FROM events),
u AS (SELECT sum(n - 1) / sum(n) AS duplicate_rate FROM d),
f AS (SELECT min(n) AS min_per_hour, count(*) FILTER (n < 10) AS thin_hours FROM filled)
SELECT round(missing_rate, 6) AS missing_rate, missing_rate <= 0.001 AS missing_ok,
  round(duplicate_rate, 6) AS duplicate_rate, duplicate_rate <= 0.001 AS duplicates_ok, min_per_hour, thin_hours,
  min_per_hour >= 10 AS volume_ok FROM m, u, f""")
def quality_gates(spark, sf):
    """Values above 400 count as missing; ten events an hour are asked for."""
    e = table(spark, sf, "events").select(
        "ts", "user_id", "event_type", F.when(F.col("value") <= 400, F.col("value")).alias("value"),
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("second"))
    return six(drift.quality_gates(e, ["value", "user_id"], "ts", ["user_id", "event_type", "second"], min_per_hour=10))


@query("baseline_shift_alert", f"""WITH {BOTH_SQL}, p AS (
  SELECT feature, avg(value) FILTER (side = 'current') / avg(value) FILTER (side = 'reference') AS ratio,
    (avg(value) FILTER (side = 'current') - avg(value) FILTER (side = 'reference'))
      / stddev_samp(value) FILTER (side = 'reference') AS sigmas FROM long GROUP BY feature)
SELECT feature, round(ratio, 6) AS ratio, round(sigmas, 6) AS sigmas, ratio > 1.04 AS ratio_alert,
  abs(sigmas) > 0.05 AS sigma_alert FROM p""")
def baseline_shift_alert(spark, sf):
    return six(drift.baseline_shift_alert(*drift_pair(spark, sf), DRIFT_COLUMNS, max_ratio=1.04, max_sigmas=0.05))


@query("retrain_trigger", f"""WITH {MODELS_SQL}, s AS (
  SELECT model, f1, precision AS pr_auc, accuracy, position > 1 AS dataset_drift, position * 3 AS days FROM metrics
), r AS (SELECT model, list_filter([CASE WHEN dataset_drift THEN 'drift' END, CASE WHEN f1 < 0.8 THEN 'f1' END,
    CASE WHEN pr_auc < 0.9 THEN 'pr_auc' END, CASE WHEN accuracy < 0.8 THEN 'accuracy' END,
    CASE WHEN days >= 7 THEN 'schedule' END], lambda x: x IS NOT NULL) AS reasons FROM s)
SELECT model, array_to_string(reasons, ',') AS reasons, len(reasons) > 0 AS retrain FROM r""")
def retrain_trigger(spark, sf):
    """Status per model: precision stands in for PR-AUC, the later models drift, each trained three days earlier."""
    position = F.array_position(F.array(*(F.lit(m) for m in ("z_score", "logistic_regression", "random_forest"))),
                                F.col("model"))
    status = model_metrics(spark, sf).select(
        "model", "f1", F.col("precision").alias("pr_auc"), "accuracy", (position > 1).alias("dataset_drift"),
        (position * 3).alias("days_since_training"))
    return drift.retrain_trigger(status).select("model", F.array_join("reasons", ",").alias("reasons"), "retrain")


@query("daily_f1_alert", f"""WITH {DAILY_SQL}, c AS (
  SELECT day, coalesce(2 * count(*) FILTER (y_true = 1 AND y_pred = 1) / nullif(count(*) FILTER (y_true = 1)
    + count(*) FILTER (y_pred = 1), 0), 0) AS f1 FROM daily GROUP BY day
), runs AS (SELECT *, f1 < 0.3 AS low, lag(f1) OVER (ORDER BY day) AS pf1,
    sum(CAST(f1 >= 0.3 AS INTEGER)) OVER (ORDER BY day) AS run FROM c
), n AS (SELECT *, CAST(sum(CAST(low AS INTEGER)) OVER (PARTITION BY run ORDER BY day) AS BIGINT) AS low_days FROM runs)
SELECT day, round(f1, 6) AS f1, low_days, low_days >= 3 AS low_alert, coalesce((pf1 - f1) / pf1 > 0.1, false) AS drop_alert
FROM n""")
def daily_f1_alert(spark, sf):
    return six(drift.daily_f1_alert(daily_scores(spark, sf), min_f1=0.3))


@query("drift_log", """WITH d AS (SELECT event_type AS feature, CAST(ts AS DATE) AS run_at, avg(value) AS score
  FROM events GROUP BY ALL)
SELECT feature, run_at, round(score, 6) AS score FROM d
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY run_at DESC) <= 12""")
def drift_log(spark, sf):
    """Daily means as the logged score of each series."""
    log = table(spark, sf, "events").groupBy(
        F.col("event_type").alias("feature"), F.col("ts").cast("date").alias("run_at")).agg(
        F.avg("value").alias("score"))
    return six(drift.keep_latest_scores(log))


@query("drift_summary_table", f"""WITH {CDF_SQL}, p AS (SELECT feature, {_pair_sql()},
  round((avg(value) FILTER (side = 'current') / avg(value) FILTER (side = 'reference') - 1) * 100, 6) AS shift_pct
  FROM long GROUP BY feature)
SELECT p.*, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted,
  CASE WHEN p_value < 0.05 THEN 'drifted' ELSE 'stable' END AS status FROM p JOIN ks USING (feature)""")
def drift_summary_table(spark, sf):
    return six(drift.drift_summary_table(*drift_pair(spark, sf), DRIFT_COLUMNS))


# -- z-score baselines: fitted on the first 25 days, applied to the rest --------------------------
Z_SQL = f"""{FEATURES_SQL}, fit AS (
  SELECT avg(volatility_60s) AS mu, stddev_samp(volatility_60s) AS sd FROM features WHERE ts < TIMESTAMP '2024-01-25'
), z AS (SELECT symbol, seq, (volatility_60s - mu) / sd AS z FROM features, fit WHERE ts >= TIMESTAMP '2024-01-25')"""


def _train_test(spark, sf):
    f = stored_features(spark, sf, columns=["volatility_60s"])
    cut = F.lit("2024-01-25").cast("timestamp_ntz")
    return f.where(F.col("ts") < cut), f.where(F.col("ts") >= cut)


@query("zscore_baseline", f"""WITH {Z_SQL}
SELECT symbol, seq, round(z, 6) AS z, CAST(z > 2 AS INTEGER) AS prediction,
  round(z / (SELECT max(z) FROM z), 6) AS score FROM z""")
def zscore_baseline(spark, sf):
    scored = models.zscore_baseline(*_train_test(spark, sf))
    return six(scored.select("symbol", "seq", "z", "prediction", "score"))


@query("zscore_baseline_two_sided", f"""WITH {Z_SQL}
SELECT symbol, seq, round(z, 6) AS z, CAST(abs(z) > 2 AS INTEGER) AS prediction, round(abs(z), 6) AS score FROM z""")
def zscore_baseline_two_sided(spark, sf):
    scored = models.zscore_baseline(*_train_test(spark, sf), two_sided=True)
    return six(scored.select("symbol", "seq", "z", "prediction", "score"))
