"""Distribution shift between a reference sample and a current sample, and what to do about it."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.columns import per
from tickloom.operators.evaluation import classification_metrics
from tickloom.operators.ordered import cumulative
from tickloom.operators.stats import column_quantiles, correlation_matrix, missing_values, per_column, unpivoted

REFERENCE, CURRENT = "reference", "current"


def common_columns(reference: DataFrame, current: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Those of ``wanted`` that both samples have, in that order."""
    return [c for c in wanted if c in reference.columns and c in current.columns]


def both_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    return reference.select(*columns, F.lit(REFERENCE).alias("side")).unionByName(
        current.select(*columns, F.lit(CURRENT).alias("side"))
    )


def latest(df: DataFrame, order: str, tiebreak: str, n: int) -> DataFrame:
    """The last ``n`` rows by time (10 000 reference and 5 000 current rows by default in drift runs)."""
    return df.orderBy(F.desc(order), F.desc(tiebreak)).limit(n)


def _distributions(reference: DataFrame, current: DataFrame, columns: Sequence[str], chunk_rows=None, kept=None) -> DataFrame:
    """Per (feature, value): both empirical distribution functions ``f_ref`` and ``f_cur`` there (``kept``: of some slices only)."""
    long = unpivoted(both_sides(reference, current, columns), columns, ["side"]).where(F.col("value").isNotNull())
    cum = cumulative(long, ["feature"], "value", {
        "ref": (F.col("side") == REFERENCE).cast("double"), "cur": (F.col("side") == CURRENT).cast("double"),
    }, chunk_rows=chunk_rows, kept=kept)
    return cum.withColumns({
        "f_ref": per(F.col("cum_ref"), F.col("all_ref")), "f_cur": per(F.col("cum_cur"), F.col("all_cur")),
    })


def kolmogorov_p(statistic: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample p-value: 2 * sum (-1)^(k-1) exp(-2 k^2 L^2), L = D sqrt(n m / (n + m))."""
    scaled = statistic * F.sqrt(n * m / (n + m))
    k = F.sequence(F.lit(1), F.lit(terms))
    series = F.aggregate(k, F.lit(0.0), lambda acc, i: acc + F.when(i % 2 == 1, 2.0).otherwise(-2.0)
                         * F.exp(-2.0 * i * i * scaled * scaled))
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))


def _may_hold_the_gap(slices: list) -> list[bool]:
    """Branch and bound: which slices of a feature's values can hold the largest gap of the two distribution functions.

    The functions are known where slices end, which gives a lower bound.  Inside a slice the gap cannot pass what it would be with
    all of the slice's reference rows before its current rows, or the other way round.
    """
    ref, cur = (sum(s.sums[k] for s in slices) for k in (0, 1))
    if not ref or not cur:
        return [i == 0 for i in range(len(slices))]  # no statistic
    least, most = 0.0, []
    for s in slices:
        start = s.sums_before[0] / ref - s.sums_before[1] / cur
        up, down = s.sums[0] / ref, s.sums[1] / cur
        least = max(least, abs(start + up - down))
        most.append(max(abs(start + up), abs(start - down)))
    return [m >= least * (1 - 1e-9) for m in most]


def ks_test(reference: DataFrame, current: DataFrame, columns: Sequence[str], alpha: float = 0.05,
            chunk_rows: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov per feature: statistic, p_value, drifted (p below alpha).

    Values are counted on a grid that is refined only where the statistic may lie; rows of the other cells are not shuffled.
    """
    gap = F.abs(F.col("f_ref") - F.col("f_cur"))
    stats = _distributions(reference, current, columns, chunk_rows, _may_hold_the_gap).groupBy("feature").agg(
        F.max(gap).alias("statistic"), F.max("all_ref").alias("_n"), F.max("all_cur").alias("_m")
    )
    return stats.withColumn("p_value", kolmogorov_p(F.col("statistic"), F.col("_n"), F.col("_m"))).select(
        "feature", "statistic", "p_value", (F.col("p_value") < alpha).alias("drifted")
    )


def wasserstein(reference: DataFrame, current: DataFrame, columns: Sequence[str], chunk_rows=None, limit: float = 0.1) -> DataFrame:
    """Area between the distribution functions, raw and in reference deviations; drifted from ``limit`` deviations on."""
    area = F.abs(F.col("f_ref") - F.col("f_cur")) * (F.col("next_value") - F.col("value"))
    distance = _distributions(reference, current, columns, chunk_rows).groupBy("feature").agg(
        F.coalesce(F.sum(area), F.lit(0.0)).alias("distance")
    )
    sd = per_column(reference, columns, {"sd": lambda c: F.stddev_samp(F.nanvl(F.col(c).cast("double"), F.lit(None)))})
    return distance.join(F.broadcast(sd), "feature").select(
        "feature", "distance", per(F.col("distance"), F.col("sd")).alias("normed_distance")
    ).withColumn("drifted", F.coalesce(F.col("normed_distance") >= limit, F.lit(False)))


def column_tests(reference: DataFrame, current: DataFrame, tests: dict[str, str], alpha: float = 0.05, limit: float = 0.1) -> DataFrame:
    """``feature, drift_score, stattest_name, threshold, drifted``: each column by the test named for it.

    ``tests``: column -> "ks" or "chisquare" (drifted below ``alpha``) or "wasserstein" (drifted from ``limit`` on).
    """
    unknown = set(tests.values()) - {"ks", "chisquare", "wasserstein"}
    if unknown or not tests:
        raise ValueError(f"tests: ks, chisquare or wasserstein for each column, not {sorted(unknown)}")
    by_test = {t: [c for c in tests if tests[c] == t] for t in tests.values()}
    parts = []
    if numeric := by_test.get("ks"):
        parts.append(ks_test(reference, current, numeric, alpha).select("feature", F.col("p_value").alias("drift_score"), "drifted", F.lit("ks").alias("stattest_name"), F.lit(alpha).alias("threshold")))
    if numeric := by_test.get("wasserstein"):
        parts.append(wasserstein(reference, current, numeric, limit=limit).select(
            "feature", F.col("normed_distance").alias("drift_score"), "drifted", F.lit("wasserstein").alias("stattest_name"), F.lit(limit).alias("threshold")))
    for column in by_test.get("chisquare", []):
        parts.append(chi_square_drift(reference, current, column, alpha).select(
            "feature", F.col("p_value").alias("drift_score"), "drifted", F.lit("chisquare").alias("stattest_name"), F.lit(alpha).alias("threshold")))
    return reduce(DataFrame.unionByName, parts)


def chi_square_p(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution, in closed form for whole degrees of freedom k.

    With h = statistic / 2: even k sum exp(-h) h^i / i! for i < k / 2; odd k add erfc(sqrt h) to the terms at half numbers.
    Terms are summed through their logarithms, so large statistics give 0 and not a failure.  Past a thousand degrees of
    freedom the cube-root normal approximation (Wilson and Hilferty) takes over, which is then good to about 1e-5.
    """
    h, k = statistic / 2, dof.cast("double")
    odd = dof % 2

    def terms(_: Column) -> Column:
        n = F.floor(F.least(k, F.lit(1000.0)) / 2).cast("int")
        steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        first = F.when(odd == 1, F.log(h) / 2 - math.log(math.gamma(1.5))).otherwise(F.lit(0.0)) - h
        start = F.struct(first.alias("log"), F.lit(0.0).alias("sum"))

        def add(acc: Column, i: Column) -> Column:
            return F.struct((acc["log"] + F.log(h) - F.log(i + 1 + odd / 2)).alias("log"), (acc["sum"] + F.exp(acc["log"])).alias("sum"))

        return F.aggregate(steps, start, add, lambda acc: acc["sum"])

    exact = terms(h) + F.when(odd == 1, _erfc(F.sqrt(h))).otherwise(F.lit(0.0))
    z = (F.pow(statistic / k, F.lit(1 / 3)) - (1 - 2 / (9 * k))) / F.sqrt(2 / (9 * k))
    tail = F.when(k <= 1000, exact).otherwise(_erfc(z / math.sqrt(2)) / 2)
    return F.when(dof < 1, F.lit(1.0)).when(statistic <= 0, F.lit(1.0)).otherwise(F.greatest(F.least(tail, F.lit(1.0)), F.lit(0.0)))


def _erfc(x: Column) -> Column:
    """Complementary error function: the series below 3, the continued fraction above."""
    a = F.abs(x)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(80)), F.struct(a.alias("term"), a.alias("sum")),
        lambda acc, n: F.struct((-acc["term"] * a * a / n).alias("term"), (acc["sum"] - acc["term"] * a * a / n / (2 * n + 1)).alias("sum")),
        lambda acc: 1 - acc["sum"] * (2 / math.sqrt(math.pi)),
    )
    fraction = F.aggregate(F.sequence(F.lit(60), F.lit(1)), a, lambda acc, n: a + n / 2 / acc)
    positive = F.when(a < 3, series).otherwise(F.exp(-a * a) / (fraction * math.sqrt(math.pi)))
    return F.when(x >= 0, positive).otherwise(2 - positive)


def chi_square_drift(reference: DataFrame, current: DataFrame, column: str, alpha: float = 0.05) -> DataFrame:
    """Chi-square test of one categorical column between the samples."""
    value = F.col(column).cast("string")
    cells = both_sides(reference, current, [column]).where(value.isNotNull()).groupBy(value.alias("value")).agg(
        F.sum((F.col("side") == REFERENCE).cast("double")).alias("ref"),
        F.sum((F.col("side") == CURRENT).cast("double")).alias("cur"),
    )
    totals = cells.agg(F.sum("ref").alias("r"), F.sum("cur").alias("c"))
    r, c = totals.select("r").scalar(), totals.select("c").scalar()
    row = F.col("ref") + F.col("cur")
    expected_ref, expected_cur = row * r / (r + c), row * c / (r + c)
    return (
        cells.agg(
            F.sum(per((F.col("ref") - expected_ref) ** 2, expected_ref)
                  + per((F.col("cur") - expected_cur) ** 2, expected_cur)).alias("statistic"),
            (F.count(F.lit(1)) - 1).alias("dof"),
        )
        .select(F.lit(column).alias("feature"), "statistic", "dof",
                chi_square_p(F.col("statistic"), F.col("dof")).alias("p_value"))
        .withColumn("drifted", F.col("p_value") < alpha)
    )


def mean_shift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Means of both samples per feature and the change in percent."""
    def mean(side: str):
        return lambda c: F.avg(F.when(F.col("side") == side, F.nanvl(F.col(c).cast("double"), F.lit(None))))

    means = per_column(both_sides(reference, current, columns), columns,
                       {"mean_ref": mean(REFERENCE), "mean_cur": mean(CURRENT)})
    return means.withColumn("shift_pct", (per(F.col("mean_cur"), F.col("mean_ref")) - 1) * 100)


def two_sample_pairing(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per feature n, mean, std, min, max of both samples side by side, in one pass over both."""
    measures = {}
    for side, short in ((REFERENCE, "ref"), (CURRENT, "cur")):
        for name, fn in {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}.items():
            measures[f"{name}_{short}"] = lambda c, fn=fn, side=side: fn(
                F.when(F.col("side") == side, F.nanvl(F.col(c).cast("double"), F.lit(None)))
            )
    return per_column(both_sides(reference, current, columns), columns, measures)


def dataset_drift(tests: DataFrame, share_limit: float = 0.5) -> DataFrame:
    """One row: number, share and names of drifted features, their scores, and whether the dataset drifted.

    ``tests``: feature, drifted, and optionally score and test name (one row per column, hence tiny).
    """
    drifted = F.col("drifted")
    columns = tests.columns
    detail = F.struct(
        (F.col("drift_score") if "drift_score" in columns else F.col("p_value") if "p_value" in columns else F.lit(None).cast("double")).alias("drift_score"),
        (F.col("stattest_name") if "stattest_name" in columns else F.lit("ks")).alias("stattest_name"),
    )
    share = F.avg(drifted.cast("double"))
    # fixed values: the keys of the published report
    return tests.agg(
        F.sum(drifted.cast("long")).alias("number_of_drifted_features"), share.alias("share_of_drifted_features"),
        (share >= share_limit).alias("dataset_drift_detected"),
        F.sort_array(F.collect_list(F.when(drifted, F.col("feature")))).alias("drifted_features"),
        F.map_from_entries(F.collect_list(F.when(drifted, F.struct("feature", detail)))).alias("drift_by_feature"),
    )


def drift_severity(n_drifted: Column, dataset_drifted: Column, require_dataset_drift: bool = True) -> Column:
    graded = F.when(n_drifted >= 5, "CRITICAL").when(n_drifted >= 3, "WARNING").otherwise("INFO")
    return F.when(~dataset_drifted, "INFO").otherwise(graded) if require_dataset_drift else graded


def severity_exit_code(severity: Column) -> Column:
    return F.when(severity == "CRITICAL", 2).when(severity == "WARNING", 1).otherwise(0)


def correlation_shift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    r = correlation_matrix(both_sides(reference, current, columns), columns, ["side"])
    pair = r.groupBy("feature_a", "feature_b").agg(
        F.max(F.when(F.col("side") == REFERENCE, F.col("correlation"))).alias("correlation_ref"),
        F.max(F.when(F.col("side") == CURRENT, F.col("correlation"))).alias("correlation_cur"),
    )
    return pair.withColumn("shift", F.col("correlation_cur") - F.col("correlation_ref"))


def missing_shift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    m = missing_values(both_sides(reference, current, columns), columns, ["side"])
    return m.groupBy("feature").agg(
        F.max(F.when(F.col("side") == REFERENCE, F.col("missing"))).alias("missing_ref"),
        F.max(F.when(F.col("side") == CURRENT, F.col("missing"))).alias("missing_cur"),
    ).withColumn("shift", F.col("missing_cur") - F.col("missing_ref"))


def quality_summary(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per sample and column: rows, missing, distinct, range, most common value, mean, std and quartiles."""
    both = both_sides(reference, current, columns)

    def known(c: str) -> Column:
        return F.nanvl(F.col(c).cast("double"), F.lit(None))

    base = per_column(both, columns, {
        "rows": lambda c: F.count(F.lit(1)), "present": lambda c: F.count(known(c)), "min": lambda c: F.min(known(c)),
        "max": lambda c: F.max(known(c)), "mean": lambda c: F.avg(known(c)), "std": lambda c: F.stddev_samp(known(c)),
    }, ["side"])
    values = (
        unpivoted(both, columns, ["side"]).where(F.col("value").isNotNull())
        .groupBy("side", "feature", "value").agg(F.count(F.lit(1)).alias("times"))
        .groupBy("side", "feature").agg(
            F.count(F.lit(1)).alias("distinct_values"),
            F.max_by("value", F.struct("times", -F.col("value"))).alias("most_common"),
        )
    )
    quartiles = column_quantiles(both, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["side"]).drop("n")
    # both sides hold one row per (sample, column)
    return (
        base.join(F.broadcast(values), ["side", "feature"], "left")
        .join(F.broadcast(quartiles), ["side", "feature"], "left")
        .withColumn("missing", F.col("rows") - F.col("present")).drop("present")
    )


def quality_gates(df: DataFrame, columns: Sequence[str], ts: str, key: Sequence[str], max_missing: float = 0.001,
                  max_duplicates: float = 0.001, min_per_hour: int = 100) -> DataFrame:
    """Missing rate, duplicate rate on ``key``, and the emptiest hour, each with its verdict."""
    cells = sum((F.sum((F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).cast("long")) for c in columns),
                F.lit(0))
    missing_rate = df.agg(per(cells, F.count(F.lit(1)) * len(columns)).alias("v")).scalar()
    copies = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    hour = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / 3_600_000_000)
    per_hour = df.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    ends = per_hour.agg(F.min("hour").alias("a"), F.max("hour").alias("b"))
    hours = ends.select(F.explode(F.sequence("a", "b")).alias("hour"))
    filled = hours.join(per_hour, "hour", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    emptiest = filled.agg(
        F.min("n").alias("min_per_hour"), F.sum((F.col("n") < min_per_hour).cast("long")).alias("thin_hours")
    )
    return copies.agg((F.sum(F.col("n") - 1) / F.sum("n")).alias("duplicate_rate")).select(
        missing_rate.alias("missing_rate"), (missing_rate <= max_missing).alias("missing_ok"),
        "duplicate_rate", (F.col("duplicate_rate") <= max_duplicates).alias("duplicates_ok"),
        emptiest.select("min_per_hour").scalar().alias("min_per_hour"),
        emptiest.select("thin_hours").scalar().alias("thin_hours"),
        (emptiest.select("min_per_hour").scalar() >= min_per_hour).alias("volume_ok"),
    )


def baseline_shift_alert(reference: DataFrame, current: DataFrame, columns: Sequence[str], max_ratio: float = 2.0,
                         max_sigmas: float = 2.0) -> DataFrame:
    """Mean more than ``max_ratio`` times the reference mean, or more than ``max_sigmas`` deviations away."""
    pair = two_sample_pairing(reference, current, columns)
    return pair.select(
        "feature", per(F.col("mean_cur"), F.col("mean_ref")).alias("ratio"),
        per(F.col("mean_cur") - F.col("mean_ref"), F.col("std_ref")).alias("sigmas"),
    ).withColumns({
        "ratio_alert": F.col("ratio") > max_ratio, "sigma_alert": F.abs("sigmas") > max_sigmas,
    })


def retrain_trigger(status: DataFrame, min_f1: float = 0.80, min_pr_auc: float = 0.90, min_accuracy: float = 0.80,
                    schedule_days: int = 7) -> DataFrame:
    """Add ``reasons`` and ``retrain`` to rows with dataset_drift, f1, pr_auc, accuracy, days_since_training."""
    rules = {
        "drift": F.col("dataset_drift"), "f1": F.col("f1") < min_f1, "pr_auc": F.col("pr_auc") < min_pr_auc,
        "accuracy": F.col("accuracy") < min_accuracy, "schedule": F.col("days_since_training") >= schedule_days,
    }
    reasons = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())), lambda x: x.isNotNull())
    return status.withColumn("reasons", reasons).withColumn("retrain", F.size("reasons") > 0)


def daily_f1_alert(predictions: DataFrame, min_f1: float = 0.78, days: int = 3, max_drop: float = 0.10) -> DataFrame:
    """F1 per day, alert on the third low day in a row, and on a drop of more than 10 % within a day.

    The windows run over one row per day, however many predictions there are.
    """
    daily = classification_metrics(predictions, ["day"]).select("day", "f1")
    w = Window.orderBy("day")
    low = (F.col("f1") < min_f1).cast("int")
    run = F.sum(1 - F.col("low")).over(w)
    before = F.lag("f1").over(w)
    return (
        daily.withColumn("low", low).withColumns({"run": run, "drop": F.coalesce(per(before - F.col("f1"), before), F.lit(0.0))})
        .withColumn("low_days", F.sum("low").over(Window.partitionBy("run").orderBy("day")))
        .select("day", "f1", F.col("low_days").cast("long").alias("low_days"),
                (F.col("low_days") >= days).alias("low_alert"), (F.col("drop") > max_drop).alias("drop_alert"))
    )


def keep_latest_scores(log: DataFrame, keep: int = 12) -> DataFrame:
    """The last ``keep`` drift runs of each feature (runs: feature, run_at, score)."""
    w = Window.partitionBy("feature").orderBy(F.desc("run_at"))
    return log.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep).drop("rank")


def log_drift_run(tests: DataFrame, run_at: Column, path: str) -> None:
    """Append one run's scores to the drift log: feature, run_at, stattest_name, score, drifted."""
    rows = tests.select("feature", run_at.alias("run_at"), "stattest_name", F.col("drift_score").alias("score"), "drifted")
    rows.write.mode("append").parquet(path)


def drift_summary_table(reference: DataFrame, current: DataFrame, columns: Sequence[str], alpha: float = 0.05):
    """Per feature: statistic, p-value, drifted or stable, and both samples' statistics."""
    tests = ks_test(reference, current, columns, alpha).withColumn(
        "status", F.when(F.col("drifted"), "drifted").otherwise("stable")
    )
    pair = two_sample_pairing(reference, current, columns)
    return tests.join(F.broadcast(pair), "feature").withColumn(
        "shift_pct", (per(F.col("mean_cur"), F.col("mean_ref")) - 1) * 100
    )
