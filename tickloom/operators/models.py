"""Splits, rule and z-score baselines, and MLlib classifiers for volatility spikes."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.columns import (
    MODEL_VERSIONS, RULE_INTENSITY, RULE_RETURN, RULE_VOLATILITY, above, class_label, per, rejected_features,
)
from tickloom.operators.evaluation import classification_metrics, ranking_scores
from tickloom.operators.ordered import ceil_of, exact_quantiles, values_at
from tickloom.schemas import FEATURES, LABEL, RUN_LOG
from tickloom.session import scratch_dir, written


# -- splits --------------------------------------------------------------------------------------
def stratified_split(df: DataFrame, label: str, row_id: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: per class the ceil(n * share) rows with the smallest hash of (id, seed) are 'test'.

    The hash at the cut is found by counting; the rows are compared with one threshold per class, not sorted.
    """
    # 15 hex digits = 60 bits, which fit a bigint
    digest = F.conv(F.substring(F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f"#{seed}"))), 1, 15), 16, 10)
    hashed = df.withColumn("_hash", digest.cast("long"))
    cut = values_at(
        hashed.select(label, "_hash"), [label], "_hash", {"_cut": lambda n: ceil_of(n * test_share) - 1}
    ).drop("n")
    # a row per label: Spark broadcasts them where they are few; rows without a label are a class of their own
    cut = cut.withColumnRenamed(label, "_class")
    return (
        hashed.join(cut, F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")
        .withColumn("split", F.when(F.col("_hash") <= F.col("_cut"), "test").otherwise("train"))
        .drop("_hash", "_cut")
    )


def temporal_split(df: DataFrame, ts: str, shares: Sequence[tuple[str, float]]) -> DataFrame:
    """Add ``split`` by time: ``shares`` such as [("train", .7), ("validation", .15), ("test", .15)]."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    ends, upto = {}, 0.0
    for name, share in shares[:-1]:
        upto += share
        ends[name] = round(upto, 10)
    cuts = exact_quantiles(df.select(us.alias("us")), [], "us", ends)
    split: Column | None = None
    for name in ends:
        before = us <= cuts.select(name).scalar()
        split = F.when(before, name) if split is None else split.when(before, name)
    return df.withColumn("split", split.otherwise(shares[-1][0]))


# -- baselines -----------------------------------------------------------------------------------
def rule_baseline(df: DataFrame) -> DataFrame:
    """Add score, prediction, p_normal, p_spike of the transparent rules (missing features count as 0)."""
    def value(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0.0)) if c in df.columns else F.lit(0.0)

    calm = (value("volatility_30s") + value("volatility_60s")) / 2
    # fixed values: the weights of the three rules
    score = (
        F.when(above(calm, RULE_VOLATILITY), 0.5).otherwise(0.0)
        + F.when(above(F.abs(value("return_60s")), RULE_RETURN), 0.3).otherwise(0.0)
        + F.when(above(value("intensity_60s"), RULE_INTENSITY), 0.2).otherwise(0.0)
    )
    return df.withColumn("score", score).withColumns({
        "prediction": (F.col("score") > 0.5).cast("int"), "p_normal": F.round(1 - F.col("score"), 9), "p_spike": F.col("score"),
    })


def zscore_baseline(train: DataFrame, test: DataFrame, column: str = "volatility_60s", limit: float = 2.0,
                    two_sided: bool = False) -> DataFrame:
    """Add z, prediction (z above the limit) and score to ``test``; mean and deviation come from ``train``.

    One-sided scores are z / max(z) of the test rows, two-sided ones abs(z).
    """
    fit = train.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"))
    mean, sd = fit.select("mean").scalar(), fit.select("sd").scalar()
    scored = test.withColumn("z", per(F.col(column) - mean, sd))
    if two_sided:
        return scored.withColumns({"prediction": above(F.abs("z"), limit).cast("int"), "score": F.abs("z")})
    largest = test.agg(F.max(F.col(column))).scalar()
    return scored.withColumns({
        "prediction": above(F.col("z"), limit).cast("int"), "score": per(F.col("z"), per(largest - mean, sd)),
    })


# -- classifiers ---------------------------------------------------------------------------------
def _assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip")


def fit_logistic_regression(train: DataFrame, columns: Sequence[str] = FEATURES, label: str = LABEL,
                            c: float = 1.0, max_iter: int = 1000) -> PipelineModel:
    """L2 with inverse strength ``c`` on unscaled features (MLlib averages the loss, hence 1 / (c * n))."""
    reg = 1.0 / (c * max(train.count(), 1))
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, regParam=reg,
                            elasticNetParam=0.0, standardization=False)
    return Pipeline(stages=[_assembler(columns), lr]).fit(train)


def _named_classes(df: DataFrame, label: str) -> DataFrame:
    """``df`` whose label column states its classes, at least two: MLlib counts up to the largest label, so that a forest of
    rows without a spike would have one class, and a single probability for each row."""
    largest = df.agg(F.max(label)).first()[0]
    return df.withMetadata(label, {"ml_attr": {"type": "nominal", "num_vals": max(2, int(largest or 0) + 1)}})


def fit_random_forest(train: DataFrame, columns: Sequence[str] = FEATURES, label: str = LABEL, trees: int = 100,
                      depth: int = 10, min_leaf: int = 10, seed: int = 42) -> PipelineModel:
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt", seed=seed,
    )
    return Pipeline(stages=[_assembler(columns), forest]).fit(_named_classes(train, label))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance), largest first; one row per model input."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def importance_of_trees(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance) summed from the splits of the stored trees: gain times weight, shares per tree, averaged."""
    forest, path = model.stages[-1], scratch_dir(spark, "trees")
    forest.write().save(path)
    weight = F.aggregate("nodeData.impurityStats", F.lit(0.0), lambda x, y: x + y)
    splits = spark.read.parquet(f"{path}/data").where("nodeData.leftChild >= 0").select(
        "treeID", F.col("nodeData.split.featureIndex").alias("place"), (F.col("nodeData.gain") * weight).alias("gain"))
    of_tree = splits.groupBy("treeID").agg(F.sum("gain").alias("whole"))
    shares = splits.join(of_tree, "treeID").groupBy("place").agg(F.sum(F.col("gain") / F.col("whole")).alias("share"))
    whole = shares.agg(F.sum("share")).scalar()
    names = spark.createDataFrame(list(enumerate(model.stages[0].getInputCols())), "place int, feature string")  # one row per input
    return names.join(shares, "place", "left").select("feature", (F.coalesce("share", F.lit(0.0)) / whole).alias("importance"))


class ForestArrays:
    """A fitted forest as flat node arrays, evaluated for blocks of rows over all trees at once.

    A leaf points to itself, so every row takes ``depth`` steps in every tree.  Size: one entry per node.
    """

    ROWS = 512

    def __init__(self, nodes: list, trees: int):
        nodes = sorted(nodes, key=lambda r: (r["treeID"], r["nodeData"]["id"]))
        first = {}
        for i, r in enumerate(nodes):
            first.setdefault(r["treeID"], i - r["nodeData"]["id"])
        self.roots = np.array([first[t] for t in range(trees)], dtype=np.int32)
        n = len(nodes)
        self.feature, self.limit = np.zeros(n, np.int32), np.full(n, np.inf)
        self.left, self.right, self.share = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32), np.zeros(n)
        depth = np.zeros(n, np.int32)
        for i, r in enumerate(nodes):
            d, base = r["nodeData"], first[r["treeID"]]
            counts = d["impurityStats"]
            self.share[i] = counts[1] / sum(counts) if len(counts) > 1 else 0.0
            if d["leftChild"] >= 0:
                self.feature[i], self.limit[i] = d["split"]["featureIndex"], d["split"]["leftCategoriesOrThreshold"][0]
                self.left[i], self.right[i] = base + d["leftChild"], base + d["rightChild"]
                depth[self.left[i]] = depth[self.right[i]] = depth[i] + 1
        self.depth = int(depth.max(initial=0))

    def probability(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows))
        for low in range(0, len(rows), self.ROWS):
            block = rows[low:low + self.ROWS]
            at = np.broadcast_to(self.roots, (len(block), len(self.roots))).ravel()
            flat, begins = np.ascontiguousarray(block).ravel(), np.repeat(np.arange(len(block)) * block.shape[1], len(self.roots))
            for _ in range(self.depth):
                below = flat[begins + self.feature[at]] <= self.limit[at]
                at = np.where(below, self.left[at], self.right[at])
            out[low:low + self.ROWS] = self.share[at].reshape(len(block), -1).mean(axis=1)
        return out


def forest_arrays(spark: SparkSession, forest: RandomForestClassificationModel) -> ForestArrays:
    """Read from the model as MLlib stores it; kept with the model."""
    if not hasattr(forest, "_arrays"):
        path = scratch_dir(spark, "forest")
        forest.write().save(path)
        forest._arrays = ForestArrays(spark.read.parquet(f"{path}/data").collect(), forest.getNumTrees)  # one row per node
    return forest._arrays


def apply_model(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add prediction (int) and probability of a spike; works on batch and streaming frames.

    Rows with a missing input are left out, as in fitting.  Forests are evaluated in Arrow batches over flat arrays: MLlib
    walks its trees three times per row (raw values, probability, prediction).
    """
    forest = model.stages[-1]
    if isinstance(forest, RandomForestClassificationModel) and forest.numClasses == 2:
        inputs = model.stages[0].getInputCols()
        arrays = forest_arrays(df.sparkSession, forest)

        @F.pandas_udf("double")
        def probability(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(arrays.probability(batch.to_numpy(dtype=np.float64)))

        numeric = [F.col(c).cast("double") for c in inputs]
        known = reduce(lambda x, y: x & y, (c.isNotNull() & ~F.isnan(c) for c in numeric))
        scored = df.where(known).withColumn("probability", probability(F.struct(*(c.alias(f"x{i}") for i, c in enumerate(numeric)))))
        return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int")).select(*df.columns, "prediction", "probability")
    scored = model.transform(df)
    return (
        scored.withColumn("_p", vector_to_array("probability")[1])
        .drop("features", "rawPrediction", "probability")
        .withColumns({"prediction": F.col("prediction").cast("int"), "probability": F.col("_p")}).drop("_p")
    )


def validate_features(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Add ``reasons`` (names of absent or non-numeric features) and ``valid``."""
    return df.withColumn("reasons", rejected_features(columns)).withColumn("valid", F.size("reasons") == 0)


def predict_batch(model: PipelineModel, df: DataFrame, columns: Sequence[str] = FEATURES):
    """(scored valid rows, rejected rows with reasons)."""
    checked = validate_features(df, columns)
    valid = checked.where("valid").drop("valid", "reasons")
    valid = valid.withColumns({c: F.col(c).cast("double") for c in columns})
    return apply_model(model, valid), checked.where(~F.col("valid")).drop("valid")


def active_variant(variant: str | None) -> str:
    name = (variant or "ml").lower()
    return name if name in MODEL_VERSIONS else "ml"


def score_with_variant(df: DataFrame, variant: str | None, model: PipelineModel | None = None) -> DataFrame:
    """Prediction records: prediction, probability (4 digits), class_label, model_version, predicted_at."""
    name = active_variant(variant)
    if name == "baseline":
        scored = rule_baseline(df).withColumn("probability", F.col("p_spike")).drop("score", "p_normal", "p_spike")
    else:
        if model is None:
            raise ValueError("variant 'ml' needs a fitted model")
        scored = apply_model(model, df)
    return scored.withColumns({
        "probability": F.round("probability", 4), "class_label": class_label(F.col("prediction")),
        "model_version": F.lit(MODEL_VERSIONS[name]), "predicted_at": F.current_timestamp(),
    })


def evaluate_scored(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, f1, roc_auc, pr_auc of rows with ``prediction`` and a score; one row per key."""
    rows = scored.select(*by, F.col(label).alias("y_true"), F.col("prediction").alias("y_pred"),
                         F.col(score).alias("score"))
    rows = written(rows, "scored")  # model output is computed once, for the counts and for the ordering
    counts, ranks = classification_metrics(rows, by), ranking_scores(rows, by).withColumnRenamed("average_precision", "pr_auc")
    if by:
        return counts.join(ranks, list(by), "left")
    return counts.withColumns({c: ranks.select(c).scalar() for c in ("roc_auc", "pr_auc")})


def train_compare(train: DataFrame, test: DataFrame, columns: Sequence[str] = FEATURES, label: str = LABEL,
                  trees: int = 100, max_iter: int = 1000) -> tuple[DataFrame, dict[str, PipelineModel], DataFrame]:
    """Fit and evaluate z-score, logistic regression and random forest.

    Returns (metrics: one row per model, fitted models, run log rows).
    """
    spark = train.sparkSession
    models = {
        "logistic_regression": fit_logistic_regression(train, columns, label, max_iter=max_iter),
        "random_forest": fit_random_forest(train, columns, label, trees=trees),
    }
    keep = [F.col(label).alias("y_true"), "prediction"]
    scored = zscore_baseline(train, test).select(F.lit("z_score").alias("model"), *keep, "score")
    for name, model in models.items():
        scored = scored.unionByName(
            apply_model(model, test).select(F.lit(name).alias("model"), *keep, F.col("probability").alias("score"))
        )
    metrics = written(evaluate_scored(scored, "y_true", "score", ["model"]), "metrics")  # a row per model, which callers read again and again
    parameters = {
        "z_score": {"z_threshold": "2.0"},
        "logistic_regression": {"C": "1.0", "max_iter": str(max_iter)},
        "random_forest": {"n_estimators": str(trees), "max_depth": "10", "min_leaf": "10"},
    }
    names = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    params = spark.createDataFrame(list(parameters.items()), "model string, params map<string,string>")
    runs = metrics.join(F.broadcast(params), "model").select(
        F.col("model").alias("run_name"), F.lit(started).cast("timestamp").alias("started_at"), "params",
        F.map_from_arrays(F.array(*(F.lit(n) for n in names)), F.array(*names)).alias("metrics"),
    )
    return metrics, models, runs.select(*RUN_LOG.fieldNames())


def scoring_throughput(scored: DataFrame, window_seconds: float = 60.0) -> DataFrame:
    """Time one full evaluation of ``scored`` (without keeping it) against twice the window."""
    rows = scored.count()
    start = time.perf_counter()
    scored.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    timed = scored.sparkSession.range(1).select(
        F.lit(rows).cast("long").alias("rows"), F.lit(seconds).alias("seconds"), F.lit(2.0 * window_seconds).alias("allowed_seconds"))
    return timed.withColumns({
        "rows_per_second": F.col("rows") / F.col("seconds"), "ms_per_row": per(F.col("seconds") * 1000, F.col("rows")),
        "times_faster": F.col("allowed_seconds") / F.col("seconds"), "in_time": F.col("seconds") < F.col("allowed_seconds"),
    })


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
