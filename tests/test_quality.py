"""Evaluation scores, drift tests and profiles against plain formulas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import drift, evaluation as ev, stats
from tickloom.operators.drift import chi_square_p


def scored(spark, y, s):
    return spark.createDataFrame(list(zip(map(int, y), map(float, s))), "y_true int, score double")


@pytest.mark.parametrize("chunk_rows", [None, 30])
def test_roc_auc_and_average_precision(spark, chunk_rows):
    rng = np.random.default_rng(1)
    y = rng.random(400) < 0.3
    s = np.round(rng.normal(y * 0.8, 1), 1)
    df = scored(spark, y, s)
    pos, neg = s[y], s[~y]
    auc = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    ap, before = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        recall = (pos >= t).mean()
        ap += (recall - before) * (pos >= t).sum() / (s >= t).sum()
        before = recall
    assert ev.roc_auc(df, chunk_rows=chunk_rows).first()[0] == pytest.approx(auc)
    assert ev.average_precision(df, chunk_rows=chunk_rows).first()[0] == pytest.approx(ap)


def test_perfect_ranking(spark):
    df = scored(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])
    assert ev.average_precision(df).first()[0] == 1.0
    assert ev.roc_auc(df).first()[0] == 1.0
    curve = ev.pr_curve(df).collect()
    assert len(curve) == 5 and [r for r in curve if r["threshold"] is None][0]["recall"] == 0.0


def test_metrics_without_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y_true int, y_pred int")
    row = ev.classification_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_latency_ranks_of_twenty_requests(spark):
    """With 20 requests p95 and p99 are both the maximum, p50 is the eleventh."""
    df = spark.createDataFrame([(float(i), i) for i in range(1, 21)], "latency_seconds double, i int").select(
        "latency_seconds", F.timestamp_seconds("i").alias("ts"))
    row = ev.latency_report(df, F.lit(True)).first()
    assert row["p50_ms"] == 11_000 and row["p95_ms"] == row["p99_ms"] == row["max_ms"] == 20_000
    assert row["median_ms"] == 10_500


def test_latency_report_without_success(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 2)], "latency_seconds double, i int").select(
        "latency_seconds", F.timestamp_seconds("i").alias("ts"))
    row = ev.latency_report(df, F.lit(False)).first()
    assert row["success_rate"] == 0 and row["p95_ms"] == 0 and row["mean_ms"] == 0


def samples(spark, seed=0):
    rng = np.random.default_rng(seed)
    a = pd.DataFrame({"x": rng.normal(0, 1, 500), "y": rng.exponential(1, 500).round(1)})
    b = pd.DataFrame({"x": rng.normal(0.5, 1, 400), "y": rng.exponential(1, 400).round(1)})
    return a, b, spark.createDataFrame(a), spark.createDataFrame(b)


@pytest.mark.parametrize("chunk_rows", [None, 50])
def test_ks_and_wasserstein(spark, chunk_rows):
    a, b, ra, rb = samples(spark)
    ks = {r["feature"]: r for r in drift.ks_test(ra, rb, ["x", "y"], chunk_rows=chunk_rows).collect()}
    wd = {r["feature"]: r for r in drift.wasserstein(ra, rb, ["x", "y"], chunk_rows=chunk_rows).collect()}
    for c in ("x", "y"):
        grid = np.unique(np.concatenate([a[c], b[c]]))
        fa = np.searchsorted(np.sort(a[c]), grid, side="right") / len(a)
        fb = np.searchsorted(np.sort(b[c]), grid, side="right") / len(b)
        assert ks[c]["statistic"] == pytest.approx(np.abs(fa - fb).max())
        assert wd[c]["distance"] == pytest.approx((np.abs(fa - fb)[:-1] * np.diff(grid)).sum())
        assert wd[c]["normed_distance"] == pytest.approx(wd[c]["distance"] / a[c].std())
    assert ks["x"]["drifted"] and not ks["y"]["drifted"]


def test_sample_against_itself(spark):
    _, _, ra, _ = samples(spark)
    for r in drift.ks_test(ra, ra, ["x", "y"]).collect():
        assert r["statistic"] == 0 and r["p_value"] == 1 and not r["drifted"]
    assert all(r["distance"] == 0 for r in drift.wasserstein(ra, ra, ["x", "y"]).collect())


def test_kolmogorov_p_known_value(spark):
    """The limiting distribution at 1.36 leaves 0.0495 (the classical 5 % point)."""
    n = F.lit(200.0)
    p = spark.range(1).select(drift.kolmogorov_p(F.lit(0.136), n, n)).first()[0]
    assert p == pytest.approx(0.0495, abs=2e-4)


@pytest.mark.parametrize("x, dof, p", [(3.841458821, 1, 0.05), (5.991464547, 2, 0.05), (18.30703805, 10, 0.05),
                                       (2.0, 4, 3 * math.exp(-1) - math.exp(-1)), (200.0, 3, 4.2e-43)])
def test_chi_square_tail(spark, x, dof, p):
    expected = math.exp(-x / 2) * (1 + x / 2) if dof == 4 else p
    got = spark.range(1).select(chi_square_p(F.lit(float(x)), F.lit(dof))).first()[0]
    assert got == pytest.approx(expected, rel=2e-2 if dof == 3 else 1e-8)


def test_extended_stats_follow_the_corrected_moments(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.lognormal(0, 1, 300), "b": np.where(rng.random(300) < 0.1, np.nan, rng.normal(size=300))})
    got = {r["feature"]: r for r in stats.extended_stats(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    for c in ("a", "b"):
        assert got[c]["skewness"] == pytest.approx(pdf[c].skew())
        assert got[c]["kurtosis"] == pytest.approx(pdf[c].kurtosis())
        assert got[c]["median"] == pytest.approx(pdf[c].median())
        assert got[c]["missing"] == pdf[c].isna().sum()


def test_correlation_of_a_constant_is_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    assert math.isnan(stats.correlation_matrix(df, ["a", "b"]).first()["correlation"])
    assert stats.strong_correlations(df, ["a", "b"]).count() == 0


def test_correlation_equals_pandas(spark, monkeypatch):
    """Large levels, missing and infinite values, constants, values known apart from each other; many blocks and keys."""
    monkeypatch.setattr(stats, "_GRAM_ROWS", 37)
    rng = np.random.default_rng(6)
    n = 1500
    base = rng.normal(size=n)
    pdf = pd.DataFrame({
        "a": 1e9 + base, "b": 3e9 - base + rng.normal(size=n) * 0.1, "c": np.where(rng.random(n) < 0.4, np.nan, base ** 2), "d": np.full(n, 0.1),
        "e": np.where(np.arange(n) % 2 == 0, base, np.nan), "f": np.where(np.arange(n) % 2 == 1, base, np.nan), "i": np.where(np.arange(n) == 7, np.inf, base),
        "k": np.arange(n) % 3})
    df = spark.createDataFrame(pdf).repartition(7)
    names = list("abcdefi")

    def check(got, want):
        found = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in got}
        assert ("e", "f") not in found  # never known together
        for (a, b), r in found.items():
            if "d" in (a, b) or ("i" in (a, b) and "e" not in (a, b)):  # e is unknown where i is infinite
                assert math.isnan(r), (a, b)
            else:
                assert r == pytest.approx(want.loc[a, b], abs=1e-6), (a, b)
        assert len(found) == 20

    check(stats.correlation_matrix(df, names).collect(), pdf[names].corr())
    keyed = stats.correlation_matrix(df.where("k < 2"), ["a", "c"], ["k"]).collect()
    assert {r["k"]: round(r["correlation"], 6) for r in keyed} == {k: round(pdf[pdf.k == k][["a", "c"]].corr().loc["a", "c"], 6) for k in (0, 1)}


def test_correlation_reads_the_rows_once(spark):
    from tickloom.session import scratch_dir

    path = scratch_dir(spark, "gram-input")
    spark.range(100).select(*((F.col("id") * (i + 1) % 17).cast("double").alias(f"c{i}") for i in range(40))).write.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    assert stats.correlation_matrix(spark.read.parquet(path), [f"c{i}" for i in range(40)]).count() == 40 * 39 // 2
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= 8  # however many pairs


def test_duplicates_are_exact(spark):
    rows = [(1, None, 0.0), (1, None, -0.0), (None, 1, 0.0), (1, 1, float("nan")), (1, 1, float("nan")), (2, 3, None), (2, 3, None), (2, 3, None), (5, 5, 5.0)]
    df = spark.createDataFrame(rows, "a int, b int, c double")
    got = stats.duplicate_rows(df).first()
    assert (got["rows"], got["duplicates"]) == (9, 4) and got["duplicate_pct"] == pytest.approx(400 / 9)
    assert stats.duplicate_rows(df.distinct()).first()["duplicates"] == 0
    assert stats.duplicate_rows(df.limit(0)).first()["rows"] is None


def test_colliding_digests_are_compared_in_full(spark, monkeypatch):
    monkeypatch.setattr(stats, "_digest", lambda df: [F.lit(1).cast("long").alias("_d1"), F.lit(2).cast("long").alias("_d2")])
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "a int")
    assert stats.duplicate_rows(df).first()["duplicates"] == 1


def test_sketches_merge_and_keep_their_error(spark):
    df = spark.range(200_000).select((F.col("id") % 60_000).cast("double").alias("x"), (F.col("id") % 7 - 3.0).alias("y"), (F.col("id") % 30).alias("day"))
    daily = stats.distinct_sketches(df, ["x", "y"], ["day"])
    merged = {r["feature"]: r["distinct_values"] for r in stats.merged_distinct(daily).collect()}
    whole = {r["feature"]: r["distinct_values"] for r in stats.distinct_counts(df, ["x", "y"], approximate=True).collect()}
    for got in (merged, whole):
        assert got["y"] == 7 and abs(got["x"] - 60_000) <= 60_000 * 4 * 1.04 / 64


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    got = {r["bin"]: r["count"] for r in stats.histogram(df, "v", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    one = stats.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v", 5).collect()
    assert {r["bin"]: r["count"] for r in one} == {0: 0, 1: 0, 2: 3, 3: 0, 4: 0}


def test_dataset_drift_details(spark):
    tests = spark.createDataFrame([("b", True, 0.01), ("a", True, 0.02), ("c", False, 0.9)],
                                  "feature string, drifted boolean, p_value double")
    row = drift.dataset_drift(tests).first()
    assert row["drifted_features"] == ["a", "b"] and row["dataset_drift_detected"]
    assert row["drift_by_feature"]["a"]["drift_score"] == 0.02 and len(row["drift_by_feature"]) == 2


def test_three_low_days(spark):
    rows = [(d, y, p) for d, (y, p) in enumerate([(1, 1), (1, 0), (1, 0), (1, 0), (1, 1)])]
    df = spark.createDataFrame(rows, "d int, y_true int, y_pred int").select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("day"), "y_true", "y_pred")
    got = drift.daily_f1_alert(df).orderBy("day").collect()
    assert [r["low_alert"] for r in got] == [False, False, False, True, False]
    assert [r["drop_alert"] for r in got] == [False, True, False, False, False]


@pytest.mark.parametrize("few", [10, 10**6])
def test_quantiles_from_brackets(spark, monkeypatch, few):
    """Bracketed by sketches or taken whole: exact quantiles, with ties, NULL, NaN and infinite values."""
    monkeypatch.setattr(stats, "_FEW", few)
    monkeypatch.setattr(stats, "_HALF", 0.002)
    rng = np.random.default_rng(3)
    n = 4000
    a, b = rng.normal(size=n).round(2), np.where(rng.random(n) < 0.4, 5.0, rng.lognormal(0, 3, n))
    a[::7], b[::500] = np.nan, np.inf
    rows = [(None if i % 11 == 0 else float(x), float(y), None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    probs = {"low": 0.01, "q1": 0.25, "half": 0.5, "top": 0.95, "least": 0.0, "most": 0.9}
    got = {r["feature"]: r for r in stats.column_quantiles(df, ["a", "b", "c"], probs).collect()}
    assert set(got) == {"a", "b"}
    for c, values in (("a", [r[0] for r in rows]), ("b", [r[1] for r in rows])):
        known = np.array([v for v in values if v is not None and not np.isnan(v)])
        assert got[c]["n"] == len(known)
        for name, q in probs.items():
            assert got[c][name] == pytest.approx(np.quantile(known, q), rel=1e-12)


def test_chi_square_tails_of_tables(spark):
    """Against known tails: 1 - CDF at chosen points."""
    known = [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (24.724970, 11, 0.01), (1.0, 1, 0.317311), (0.0, 4, 1.0),
             (124.342113, 100, 0.05), (2000.0, 3, 0.0), (30.0, 1, 4.320463e-08)]
    rows = spark.createDataFrame([(s, k, p) for s, k, p in known], "s double, k long, p double")
    for r in rows.withColumn("got", chi_square_p(F.col("s"), F.col("k"))).collect():
        assert r["got"] == pytest.approx(r["p"], rel=2e-4, abs=1e-12), r
