"""Quality of predictions: confusion counts, threshold-free scores, model comparison, prediction logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.columns import per
from tickloom.operators.ordered import ceil_of, cumulative, floor_of, values_at

# Upper bounds of the published confidence histogram.
CONFIDENCE_BOUNDS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0]


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def confusion_matrix(df: DataFrame, by: Sequence[str] = (), y_true: str = "y_true", y_pred: str = "y_pred"):
    def cell(t: int, p: int) -> Column:
        return F.sum(((F.col(y_true) == t) & (F.col(y_pred) == p)).cast("long"))

    return df.groupBy(*by).agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"),
                               cell(1, 1).alias("tp"))


def classification_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, f1 (0 for an empty denominator)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion_matrix(df, by).select(
        *by, ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_report(df: DataFrame) -> DataFrame:
    """Per class precision, recall, f1, support; then accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    scores = {
        "0": (ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(2 * tn, 2 * tn + fn + fp), tn + fp),
        "1": (ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(2 * tp, 2 * tp + fp + fn), tp + fn),
    }
    total = tn + fp + fn + tp

    def row(name: str, precision, recall, f1, support) -> Column:
        return F.struct(F.lit(name).alias("label"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), support.alias("support"))

    a, b = scores["0"], scores["1"]
    accuracy = ratio(tp + tn, total)
    rows = [row("0", *a), row("1", *b), row("accuracy", accuracy, accuracy, accuracy, total)]
    rows.append(row("macro avg", *((x + y) / 2 for x, y in zip(a[:3], b[:3])), total))
    rows.append(row("weighted avg", *(ratio(x * a[3] + y * b[3], total) for x, y in zip(a[:3], b[:3])), total))
    return confusion_matrix(df).select(F.inline(F.array(*rows)))


def _by_score(df: DataFrame, by: Sequence[str], chunk_rows: int | None, descending: bool) -> DataFrame:
    positive = F.col("y_true").cast("double")
    return cumulative(df, by, "score", {"pos": positive, "neg": 1 - positive}, descending, chunk_rows)


def ranking_scores(df: DataFrame, by: Sequence[str] = (), chunk_rows: int | None = None) -> DataFrame:
    """``roc_auc`` and ``average_precision`` from one ordering of the scores; one row per key."""
    below = F.col("cum_neg") - F.col("neg") / 2
    pos, neg = (F.col(f"all_{c}") - F.col(f"cum_{c}") + F.col(c) for c in ("pos", "neg"))  # from this score up
    return _by_score(df, by, chunk_rows, False).groupBy(*by).agg(
        per(F.sum(F.col("pos") * below), F.max("all_pos") * F.max("all_neg")).alias("roc_auc"),
        F.sum(per(F.col("pos"), F.col("all_pos")) * (pos / (pos + neg))).alias("average_precision"),
    )


def roc_auc(df: DataFrame, by: Sequence[str] = (), chunk_rows: int | None = None) -> DataFrame:
    """Probability that a positive scores above a negative, ties counting one half."""
    return ranking_scores(df, by, chunk_rows).drop("average_precision")


def average_precision(df: DataFrame, by: Sequence[str] = (), chunk_rows: int | None = None) -> DataFrame:
    """Sum over distinct scores, from the top, of recall gained times precision there (no interpolation)."""
    return ranking_scores(df, by, chunk_rows).drop("roc_auc")


def pr_curve(df: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score, the end point (NULL, 1, 0), and the base rate."""
    base_rate = F.col("all_pos") / (F.col("all_pos") + F.col("all_neg"))
    points = _by_score(df, [], chunk_rows, True).select(
        F.col("score").alias("threshold"), (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        per(F.col("cum_pos"), F.col("all_pos")).alias("recall"), base_rate.alias("base_rate"),
    )
    end = df.agg(F.avg(F.col("y_true").cast("double")).alias("base_rate")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        "base_rate",
    )
    return points.unionByName(end)


def compare_models(metrics: DataFrame, score: str, order: Sequence[str]) -> DataFrame:
    """Model metrics with the best flag, the change in percent to the model before it in ``order``, and the advice
    that change gives."""
    position = F.array_position(F.array(*(F.lit(m) for m in order)), F.col("model"))
    one_row_per_model = Window.partitionBy(F.lit(0))
    before = F.lag(score).over(one_row_per_model.orderBy("position"))
    change = F.col("change_pct")
    return (
        metrics.withColumn("position", position)
        .withColumns({
            "change_pct": per(F.col(score) - before, before) * 100,
            "is_best": F.max_by("model", F.struct(F.col(score), -F.col("position"))).over(one_row_per_model)
            == F.col("model"),
        })
        .withColumn("advice", F.when(change.isNull(), "baseline")
                    .when(F.abs(change) < 1, "keep simpler model").when(change > 5, "use this model")
                    .when(change > 0, "marginal").otherwise("keep simpler model"))
        .drop("position")
    )


def best_model(metrics: DataFrame, score: str) -> DataFrame:
    return metrics.agg(F.max_by("model", score).alias("model"), F.max(score).alias(score))


def prediction_distribution(log: DataFrame) -> DataFrame:
    """Predictions per class and model version, and the share of spikes of that version."""
    label = F.when(F.col("prediction") == 1, "spike").otherwise("normal")
    counts = (
        log.where(F.col("prediction").isNotNull())
        .groupBy(label.alias("class_label"), "model_version").agg(F.count(F.lit(1)).alias("predictions"))
    )
    version = Window.partitionBy("model_version")
    spikes = F.sum(F.when(F.col("class_label") == "spike", F.col("predictions")).otherwise(0)).over(version)
    return counts.withColumn("spike_share", spikes / F.sum("predictions").over(version))


def cumulative_buckets(df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Per key and upper bound ``le`` (the last one infinite) the number of values up to it.

    One conditional sum per bound: rows are not multiplied.
    """
    names = [f"_le{i}" for i in range(len(bounds))]
    wide = df.where(F.col(value).isNotNull()).groupBy(*by).agg(
        *(F.sum((F.col(value) <= F.lit(float(b))).cast("long")).alias(n) for b, n in zip(bounds, names)),
        F.count(F.lit(1)).alias("_all"),
    )
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(n).alias("cumulative")) for b, n in zip(bounds, names)]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_all").alias("cumulative")))
    return wide.select(*by, F.inline(F.array(*rows)))


def confidence_histogram(log: DataFrame) -> DataFrame:
    labelled = log.where(F.col("prediction").isNotNull()).withColumn(
        "class_label", F.when(F.col("prediction") == 1, "spike").otherwise("normal")
    )
    return cumulative_buckets(labelled, "probability", CONFIDENCE_BOUNDS, ["class_label"])


def error_breakdown(log: DataFrame) -> DataFrame:
    return (
        log.where(F.col("error_type").isNotNull()).groupBy("error_type").agg(F.count(F.lit(1)).alias("errors"))
        .orderBy(F.desc("errors"), "error_type")
    )


def latency_report(log: DataFrame, success: Column, total_seconds: float | None = None,
                   p95_target_ms: float = 100.0, success_target: float = 99.0) -> DataFrame:
    """Totals, rates and latency statistics (ms, over successful requests); percentile p is the value at rank
    min(floor(n * p / 100), n - 1)."""
    ms = F.when(success, F.col("latency_seconds") * 1000)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = F.lit(float(total_seconds)) if total_seconds else (F.max(us) - F.min(us)) / 1e6
    base = log.agg(
        F.count(F.lit(1)).alias("total_requests"), F.sum(success.cast("long")).alias("successful_requests"),
        seconds.alias("total_seconds"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"),
        F.avg(ms).alias("mean_ms"), F.stddev_samp(ms).alias("std_ms"),
    )
    good = log.where(success).select((F.col("latency_seconds") * 1000).alias("ms"))
    # floor(n p / 100) < n for every p below 100, so the last rank needs no further clamp
    ranks = {f"p{p}_ms": lambda n, p=p: floor_of(n * p / 100) for p in (50, 95, 99)}
    ranks |= {"_lo": lambda n: floor_of((n - 1) * 0.5), "_hi": lambda n: ceil_of((n - 1) * 0.5)}
    picked = values_at(good, [], "ms", ranks)
    zero = F.lit(0.0)
    picks = {n: F.coalesce(picked.select(n).scalar(), zero) for n in ranks}
    out = base.select(
        "total_requests", "successful_requests",
        (F.col("total_requests") - F.col("successful_requests")).alias("failed_requests"),
        ratio(F.col("successful_requests") * 100, F.col("total_requests")).alias("success_rate"),
        ratio(F.col("total_requests"), F.col("total_seconds")).alias("requests_per_second"),
        *(F.coalesce(c, zero).alias(c) for c in ("min_ms", "max_ms", "mean_ms", "std_ms")),
        ((picks["_lo"] + picks["_hi"]) / 2).alias("median_ms"),
        *(picks[n].alias(n) for n in ("p50_ms", "p95_ms", "p99_ms")),
    )
    return out.withColumns({
        "p95_ok": F.col("p95_ms") <= p95_target_ms, "success_ok": F.col("success_rate") >= success_target,
    })
