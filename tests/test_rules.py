"""Rule baseline, bands, severity and validity: the published cases."""

import pytest
from pyspark.sql import functions as F

from tickloom.functions import columns as cols
from tickloom.operators.drift import drift_severity, retrain_trigger, severity_exit_code
from tickloom.operators.models import active_variant, rule_baseline, validate_features
from tickloom.operators.slo import histogram_quantile, lag_by_topic, release_gate, rollback_decision, sustained_alerts
from tickloom.schemas import FEATURES

# The published cases (name, volatility_30s, volatility_60s, return_60s, intensity_60s, score, prediction).
CASES = [
    ("calm", 0.001, 0.001, 0.0001, 5.0, 0.0, 0),
    ("strong", 0.08, 0.09, 0.03, 280.0, 1.0, 1),
    ("volatility only", 0.08, 0.09, 0.0001, 5.0, 0.5, 0),
    ("normal", 0.01, 0.015, 0.002, 20.0, 0.0, 0),
    ("spike", 0.045, 0.05, 0.015, 75.0, 1.0, 1),
    ("borderline", 0.025, 0.028, 0.008, 45.0, 0.0, 0),
    ("empty", None, None, None, None, 0.0, 0),
]


def test_rule_baseline(spark):
    df = spark.createDataFrame(
        [c[:5] for c in CASES],
        "name string, volatility_30s double, volatility_60s double, return_60s double, intensity_60s double")
    got = {r["name"]: r for r in rule_baseline(df).collect()}
    for name, *_, score, prediction in CASES:
        assert (got[name]["score"], got[name]["prediction"]) == (score, prediction)
        assert got[name]["p_normal"] + got[name]["p_spike"] == pytest.approx(1.0)
    assert got["spike"]["p_spike"] > got["calm"]["p_spike"]


def test_rule_baseline_without_columns(spark):
    assert rule_baseline(spark.range(1)).first()["prediction"] == 0


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("n, dataset, gated, severity, code", [
    (0, False, True, "INFO", 0), (7, False, True, "INFO", 0), (2, True, True, "INFO", 0), (3, True, True, "WARNING", 1),
    (4, True, True, "WARNING", 1), (5, True, True, "CRITICAL", 2), (5, False, False, "CRITICAL", 2),
])
def test_severity(spark, n, dataset, gated, severity, code):
    c = drift_severity(F.lit(n), F.lit(dataset), gated)
    assert one(spark, c) == severity
    assert one(spark, severity_exit_code(c)) == code


@pytest.mark.parametrize("fn, value, label", [
    (cols.liquidity_status, 0.0099, "High"), (cols.liquidity_status, 0.01, "Medium"), (cols.liquidity_status, 0.05, "Low"),
    (cols.activity_status, 0.9, "Quiet"), (cols.activity_status, 1.0, "Normal"), (cols.activity_status, 5.0, "Active"),
    (cols.pr_auc_rating, 0.95, "Excellent"), (cols.pr_auc_rating, 0.951, "Outstanding"), (cols.pr_auc_rating, 0.3, "Poor"),
    (cols.latency_assessment, 49.9, "EXCELLENT"), (cols.latency_assessment, 189.4, "ACCEPTABLE"),
    (cols.latency_assessment, 200.0, "NEEDS IMPROVEMENT"), (cols.drift_score_band, 0.3, "minor"),
    (cols.drift_score_band, 0.7, "high"), (cols.drift_share_action, 0.3, "accelerate"),
    (cols.drift_share_action, 0.5, "accelerate"), (cols.drift_share_action, 0.51, "rollback"),
    (cols.lag_band, 999.0, "green"), (cols.lag_band, 1000.0, "yellow"), (cols.lag_band, 10000.0, "red"),
])
def test_bands(spark, fn, value, label):
    assert one(spark, fn(F.lit(value))) == label


def test_spike_label_is_strict(spark):
    assert one(spark, cols.spike_label(F.lit(cols.SPIKE_THRESHOLD))) == 0
    assert one(spark, cols.spike_label(F.lit(0.0418))) == 1


def test_variant_names():
    assert [active_variant(v) for v in ("ml", "BASELINE", "other", None)] == ["ml", "baseline", "ml", "ml"]


def test_validate_features(spark):
    row = {c: "1.5" for c in FEATURES}
    bad = dict(row, price=None, spread="wide")
    df = spark.createDataFrame([row, bad], ", ".join(f"{c} string" for c in FEATURES))
    good, wrong = validate_features(df).select("valid", "reasons").collect()
    assert good["valid"] and not wrong["valid"] and wrong["reasons"] == ["price", "spread"]


def test_retrain_reasons(spark):
    df = spark.createDataFrame(
        [(False, 0.9, 0.95, 0.9, 1), (True, 0.7, 0.95, 0.9, 8)],
        "dataset_drift boolean, f1 double, pr_auc double, accuracy double, days_since_training int")
    calm, due = retrain_trigger(df).collect()
    assert not calm["retrain"] and due["reasons"] == ["drift", "f1", "schedule"]


def test_rollback_and_release(spark):
    df = spark.createDataFrame(
        [(2100.0, 0.0, 0.9, 0.0), (100.0, 0.0, 0.6, 0.0), (100.0, 0.0, 0.9, 0.6), (100.0, 0.0, 0.9, 0.1)],
        "latency_ms double, error_rate double, f1 double, drift_share double")
    assert [r["target"] for r in rollback_decision(df).collect()] == [
        "baseline", "previous version", "baseline or retrain", "keep"]
    gate = spark.createDataFrame([(0.8, 0.7, 0.2), (0.8, 0.7, 0.4), (0.74, 0.7, 0.1)],
                                 "f1 double, current_f1 double, drift_share double")
    assert [r["deploy"] for r in release_gate(gate).collect()] == [True, False, False]


def test_histogram_quantile_edges(spark):
    b = spark.createDataFrame(
        [("a", 0.1, 0), ("a", 0.5, 8), ("a", float("inf"), 10), ("b", 0.1, 4), ("b", 0.5, 4), ("b", float("inf"), 4)],
        "k string, le double, cumulative long")
    got = {r["k"]: r["value"] for r in histogram_quantile(b, 0.5, ["k"]).collect()}
    assert got == {"a": pytest.approx(0.35), "b": pytest.approx(0.05)}
    top = {r["k"]: r["value"] for r in histogram_quantile(b, 0.95, ["k"]).collect()}
    assert top["a"] == 0.5  # in the infinite bucket: the highest finite bound


def test_sustained_alerts_need_consecutive_intervals(spark):
    minutes = [0, 1, 2, 3, 4, 6, 7, 8, 9]  # minute 5 is missing
    df = spark.createDataFrame([(m, 0.9) for m in minutes], "m int, p95 double").select(
        F.timestamp_seconds(F.col("m") * 60).alias("minute"), "p95")
    got = sustained_alerts(df, "p95", "minute", [("critical", 0.8, 5)]).collect()
    assert [r["intervals"] for r in got] == [5]


def test_lag_without_commit(spark):
    from tickloom.operators.slo import consumer_lag

    end = spark.createDataFrame([("t", 0, 10), ("t", 1, 5)], "topic string, partition int, log_end_offset long")
    done = spark.createDataFrame([("a", "t", 0, 7), ("b", "t", 0, 4), ("b", "t", 1, 5)], "consumer_group string, topic string, partition int, consumer_offset long")
    lag = consumer_lag(end, done)
    assert {(r["consumer_group"], r["partition"]): r["lag"] for r in lag.collect()} == {("a", 0): 3, ("a", 1): 5, ("b", 0): 6, ("b", 1): 0}
    assert {r["consumer_group"]: r["total_lag"] for r in lag_by_topic(lag).collect()} == {"a": 8, "b": 6}
