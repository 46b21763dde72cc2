"""Queries that fit, store, compare and apply classifiers, and the run log.

The job is the forecast: does volatility reach THRESHOLD in the HORIZON after the tick?  A fitted model's numbers have no SQL
twin; of the forecast the results hold every scored row, its label, and how prediction, probability and class go together.
The same models are also fitted to a label that the features decide: volatility_60s above DECIDED.  Rows farther than MARGIN from
it are predicted right by any model that has learned, and by none that is constant, permuted or fitted to other columns; these
predictions, the shares of the features and the models' scores stand in the results.  ``task`` tells which label a row is about.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import lru_cache, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.columns import MODEL_VERSIONS
from tickloom.operators import features as ops, models
from tickloom.plans.fixtures import FEATURES_SQL, TICKS_SQL, features, ticks
from tickloom.plans.registry import query
from tickloom.plans.ticks import FUTURE_SQL, RULE_SQL, SCALED_SQL, scaled_features
from tickloom.schemas import FEATURES, LABEL
from tickloom.session import scratch_dir, written
from tickloom.sources import files

HORIZON, THRESHOLD = 21_600, 8.0

#: The label is 1 above; rows within MARGIN of it may fall on either side.
DECIDED, MARGIN = 6.0, 0.5

#: Least and most rows that a task gets of train and test rows together.
ROWS_PER_TASK = 10_000, 1_000_000

SEPARABLE_SQL = f"""{FEATURES_SQL}, marked AS (
  SELECT *, CAST(volatility_60s > {DECIDED} AS INTEGER) AS {LABEL},
    CASE WHEN abs(volatility_60s - {DECIDED}) >= {MARGIN} THEN CAST(volatility_60s > {DECIDED} AS INTEGER) END AS decided FROM features
), hashed AS (
  SELECT *, row_number() OVER (PARTITION BY {LABEL} ORDER BY CAST('0x' || substr(md5(concat(CAST(seq AS VARCHAR), '#42')), 1, 15)
    AS BIGINT)) AS k, count(*) OVER (PARTITION BY {LABEL}) AS n FROM marked
), test AS (SELECT * FROM hashed WHERE k <= ceil(n * 0.2)), train AS (SELECT * FROM hashed WHERE k > ceil(n * 0.2))"""

#: Both labels: ``labelled`` and its parts beside ``marked`` and its.
TASKS_SQL = f"""{SEPARABLE_SQL}{FUTURE_SQL.removeprefix(TICKS_SQL)}, labelled AS (
  SELECT f.*, CAST(future_volatility >= {THRESHOLD} AS INTEGER) AS {LABEL} FROM features f JOIN future USING (symbol, ts)
  WHERE us + {HORIZON}000000 <= (SELECT max(epoch_us(ts)) FROM events)
), forecast_hashed AS (
  SELECT *, row_number() OVER (PARTITION BY {LABEL} ORDER BY CAST('0x' || substr(md5(concat(CAST(seq AS VARCHAR), '#42')), 1, 15)
    AS BIGINT)) AS k, count(*) OVER (PARTITION BY {LABEL}) AS n FROM labelled
), forecast_test AS (SELECT * FROM forecast_hashed WHERE k <= ceil(n * 0.2)), forecast_train AS (SELECT * FROM forecast_hashed WHERE k > ceil(n * 0.2))"""


def labelled(spark, sf):
    """Features with the forecast label, written once because fitting reads them many times."""
    return _labelled(spark, spark.sparkContext.applicationId, sf)


@lru_cache(maxsize=4)
def _labelled(spark, application, sf):
    del application
    ahead = ops.future_volatility(ticks(spark, sf), HORIZON, THRESHOLD).where("complete")
    rows = features(spark, sf).join(
        ahead.select("symbol", "ts", F.col("future_spike").alias(LABEL)), ["symbol", "ts"])
    return written(rows, "labelled")


def separable(spark, sf):
    """Features with the label that they decide."""
    return _separable(spark, spark.sparkContext.applicationId, sf)


@lru_cache(maxsize=4)
def _separable(spark, application, sf):
    del application
    rows = features(spark, sf)
    return written(rows.withColumn(LABEL, (F.col("volatility_60s") > DECIDED).cast("int")), "separable")


#: The rows of each task.
TASKS = {"forecast": labelled, "decided": separable}


def split(spark, sf, task="decided"):
    """Train and test rows, looked for once and spread evenly: fitting reads them many times, and small feature tables are a single file."""
    rows = _split(spark, spark.sparkContext.applicationId, sf, task)
    return rows.where(F.col("split") == "train").drop("split"), rows.where(F.col("split") == "test").drop("split")


@lru_cache(maxsize=4)
def _split(spark, application, sf, task):
    del application
    rows = TASKS[task](spark, sf)
    n = rows.count()
    parts = max(1, min(spark.sparkContext.defaultParallelism, n // ROWS_PER_TASK[0]), -(-n // ROWS_PER_TASK[1]))
    return written(models.stratified_split(rows, LABEL, "seq").repartition(parts), "split")


def forest(spark, sf, task="decided"):
    """One forest of 100 trees on all rows of a task, fitted once for the queries that apply it."""
    return _forest(spark, spark.sparkContext.applicationId, sf, task)


@lru_cache(maxsize=4)
def _forest(spark, application, sf, task):
    del application
    return models.fit_random_forest(TASKS[task](spark, sf))


def compared(spark, sf, task="decided"):
    return _compared(spark, spark.sparkContext.applicationId, sf, task)


@lru_cache(maxsize=4)
def _compared(spark, application, sf, task):
    """Metrics, models and run log rows of the three models at their published settings."""
    del application
    return models.train_compare(*split(spark, sf, task), FEATURES, LABEL)


def both(rows_of: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of each task below one another."""
    return reduce(DataFrame.unionByName, (rows_of(task).select(F.lit(task).alias("task"), "*") for task in TASKS))


def consistent() -> Column:
    """The prediction follows from a probability between 0 and 1."""
    p = F.col("probability")
    return ((F.col("prediction") == (p > 0.5).cast("int")) & p.between(0, 1)).alias("consistent")


def decided(value: Column) -> Column:
    """``value`` where the features decide the label beyond doubt."""
    return F.when(F.abs(F.col("volatility_60s") - DECIDED) >= MARGIN, value)


def determined(task: str, value: Column) -> Column:
    """``value`` where SQL can tell it: nowhere in the forecast."""
    return decided(value) if task == "decided" else F.when(F.lit(False), value)


SCORED_TEST_SQL = f"""WITH {TASKS_SQL}
SELECT 'decided' AS task, symbol, seq, {LABEL}, decided AS prediction, CAST(decided AS DOUBLE) AS likely, true AS consistent FROM test
UNION ALL SELECT 'forecast', symbol, seq, {LABEL}, NULL, NULL, true FROM forecast_test"""


def _scored_test(spark, sf, name):
    """Labels and predictions, and which side of one half their probabilities are on."""
    def rows_of(task):
        scored = models.apply_model(compared(spark, sf, task)[1][name], split(spark, sf, task)[1])
        return scored.select("symbol", "seq", LABEL, determined(task, F.col("prediction")).alias("prediction"),
                             determined(task, F.round("probability", 0)).alias("likely"), consistent())

    return both(rows_of)


@query("logistic_regression", SCORED_TEST_SQL)
def logistic_regression(spark, sf):
    return _scored_test(spark, sf, "logistic_regression")


@query("random_forest", SCORED_TEST_SQL)
def random_forest(spark, sf):
    return _scored_test(spark, sf, "random_forest")


def _importances(spark, sf):
    return models.feature_importance(spark, forest(spark, sf))


@query("feature_importance", f"""SELECT feature, CASE feature WHEN 'volatility_60s' THEN 'most' WHEN 'volatility_30s' THEN 'some' WHEN 'volatility_120s'
  THEN 'some' ELSE 'little' END AS share, true AS of_the_trees, 1.0::DOUBLE AS total FROM (SELECT unnest({FEATURES}) AS feature)""")
def feature_importance(spark, sf):
    """The deciding column has most, its neighbours some, the others little; the shares are those of the stored trees' splits."""
    found = _importances(spark, sf)
    total = found.agg(F.round(F.sum("importance"), 9)).scalar()
    summed = models.importance_of_trees(spark, forest(spark, sf)).withColumnRenamed("importance", "summed")
    share = F.when(F.col("importance") >= 0.3, "most").when(F.col("importance") >= 0.06, "some").otherwise("little")
    same = F.abs(F.col("importance") - F.col("summed")) < 1e-9
    return found.join(summed, "feature").select("feature", share.alias("share"), same.alias("of_the_trees"), total.alias("total"))


@query("top_features", "SELECT * FROM (VALUES (1, 'volatility_60s'), (2, 'volatility_30s'), (3, 'volatility_120s')) AS t(place, feature)")
def top_features(spark, sf):
    """The three largest shares, in falling order."""
    w = Window.orderBy(F.desc("importance"), "feature")  # one row per input
    return _importances(spark, sf).select(F.row_number().over(w).alias("place"), "feature").where("place <= 3")


@query("predict_batch", f"""WITH {TASKS_SQL}
SELECT task, seq, CASE WHEN seq % 40 <> 0 THEN decided END AS prediction, CASE WHEN seq % 40 <> 0 THEN true END AS consistent,
  CASE WHEN seq % 40 = 0 THEN 'price' END AS reason
FROM (SELECT 'decided' AS task, seq, decided FROM marked UNION ALL SELECT 'forecast', seq, NULL FROM labelled)""")
def predict_batch(spark, sf):
    """Predictions for valid rows and reasons of rejected ones (every 40th row lacks a price)."""
    def rows_of(task):
        requests = TASKS[task](spark, sf).withColumn("price", F.when(F.col("seq") % 40 != 0, F.col("price")))
        scored, rejected = models.predict_batch(forest(spark, sf, task), requests)
        valid = scored.select("seq", determined(task, F.col("prediction")).alias("prediction"), consistent(), F.lit(None).cast("string").alias("reason"))
        return valid.unionByName(rejected.select("seq", F.array_join("reasons", ",").alias("reason")), allowMissingColumns=True)

    return both(rows_of)


@query("score_with_variant", f"""WITH {FEATURES_SQL}, {SCALED_SQL}, {RULE_SQL}
SELECT seq, CAST(t > 5 AS INTEGER) AS prediction, t / 10 AS probability, CASE WHEN t > 5 THEN 'spike' ELSE 'normal' END
  AS class_label, 'baseline-1.0' AS model_version FROM tenths""")
def score_with_variant(spark, sf):
    return models.score_with_variant(scaled_features(spark, sf), "Baseline").select(
        "seq", "prediction", "probability", "class_label", "model_version")


def spread_sql(rows: str) -> str:
    """True where both labels occur in ``rows``: a model that has learned tells them apart."""
    return f"(SELECT CASE WHEN min({LABEL}) < max({LABEL}) THEN true END FROM {rows})"


@query("score_with_variant_ml", f"""WITH {TASKS_SQL}
SELECT task, seq, {LABEL}, decided AS prediction, CASE decided WHEN 1 THEN 'spike' WHEN 0 THEN 'normal' END AS class_label, true AS labelled,
  true AS four_digits, true AS consistent, true AS of_the_trees, told_apart, '{MODEL_VERSIONS["ml"]}' AS model_version
FROM (SELECT 'decided' AS task, seq, {LABEL}, decided, {spread_sql("marked")} AS told_apart FROM marked
  UNION ALL SELECT 'forecast', seq, {LABEL}, NULL, {spread_sql("labelled")} FROM labelled)""")
def score_with_variant_ml(spark, sf):
    """Labels and classes, and whether the classes follow from the predictions, these from the probabilities (of four digits), and both from
    the trees as MLlib walks them.  ``told_apart``: the mean probability of a task's spikes is at least 1.25 times that of its other rows."""
    def rows_of(task):
        model = forest(spark, sf, task)
        ours = models.score_with_variant(TASKS[task](spark, sf), "unknown", model).withColumnsRenamed({"prediction": "class", "probability": "p"})
        walked = vector_to_array("probability")[1]
        scored = written(model.transform(ours).select(
            "seq", LABEL, "volatility_60s", "class_label", "model_version", "p", F.col("class").alias("prediction"), walked.alias("walked")), "variant")
        spike, p, w = F.col("prediction") == 1, F.col("p"), F.col("walked")
        # four digits may round a probability onto one half, and MLlib sums in another order
        follows = p.between(0, 1) & F.when(spike, p >= 0.5).otherwise(p <= 0.5)
        same = (F.abs(p - w) < 0.5e-4 + 1e-9) & F.when(spike, w > 0.5 - 1e-9).otherwise(w < 0.5 + 1e-9)
        apart = scored.agg((F.avg(F.when(F.col(LABEL) == 1, p)) >= 1.25 * F.avg(F.when(F.col(LABEL) == 0, p)))).scalar()
        named = F.col("class_label") == F.when(spike, "spike").otherwise("normal")
        return scored.select("seq", LABEL, determined(task, F.col("prediction")).alias("prediction"), determined(task, F.col("class_label")).alias("class_label"),
                             named.alias("labelled"), (F.round(p, 4) == p).alias("four_digits"), follows.alias("consistent"), same.alias("of_the_trees"),
                             apart.alias("told_apart"), "model_version")

    return both(rows_of)


@query("score_with_variant_ml_records")
def score_with_variant_ml_records(spark, sf):
    """The records that score_with_variant_ml checks: prediction, probability, class and version of every row of both tasks."""
    def rows_of(task):
        return models.score_with_variant(TASKS[task](spark, sf), "unknown", forest(spark, sf, task)).select(
            "symbol", "seq", LABEL, "prediction", "probability", "class_label", "model_version")

    return both(rows_of)


@query("save_and_load_model", f"""WITH {TASKS_SQL} SELECT 'decided' AS task, seq, decided AS prediction, true AS same FROM marked
UNION ALL SELECT 'forecast', seq, NULL, true FROM labelled""")
def save_and_load_model(spark, sf):
    """A stored and reloaded model gives the probabilities of the model in memory."""
    def rows_of(task):
        path, rows = scratch_dir(spark, "model"), TASKS[task](spark, sf)
        models.save_model(forest(spark, sf, task), path)
        before = models.apply_model(forest(spark, sf, task), rows).withColumnsRenamed({"prediction": "before_class", "probability": "before"})
        after = models.apply_model(models.load_model(path), before)
        same = (F.col("probability") == F.col("before")) & (F.col("prediction") == F.col("before_class"))
        return after.select("seq", determined(task, F.col("prediction")).alias("prediction"), same.alias("same"))

    return both(rows_of)


def z_sql(name: str = "") -> str:
    """The z-score rule's metrics, from the train and test rows of a task."""
    return f""", {name}fit AS (SELECT avg(volatility_60s) AS mu, stddev_samp(volatility_60s) AS sd FROM {name}train),
{name}z AS (SELECT {LABEL} AS y, (volatility_60s - mu) / sd > 2.0 AS p FROM {name}test, {name}fit),
{name}c AS (SELECT count(*) FILTER (y = 1 AND p) AS tp, count(*) FILTER (y = 0 AND p) AS fp, count(*) FILTER (y = 1 AND NOT p) AS fn, count(*) AS n,
  count(*) FILTER ((y = 1) = p) AS hit FROM {name}z),
{name}scores AS (SELECT round(hit / n, 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM {name}c)"""


Z_SQL = SEPARABLE_SQL + z_sql()


@query("train_compare", f"""WITH {TASKS_SQL}{z_sql()}{z_sql("forecast_")}
SELECT 'decided' AS task, 'z_score' AS model, accuracy, precision, recall, f1, f1 >= 0.9 AS has_learned, true AS ranks_well, true AS consistent FROM scores
UNION ALL SELECT 'decided', unnest(['logistic_regression', 'random_forest']), NULL, NULL, NULL, NULL, true, true, true
UNION ALL SELECT 'forecast', 'z_score', accuracy, precision, recall, f1, NULL, NULL, true FROM forecast_scores
UNION ALL SELECT 'forecast', unnest(['logistic_regression', 'random_forest']), NULL, NULL, NULL, NULL, NULL, NULL, true""")
def train_compare(spark, sf):
    """The z-score rule's metrics in full; of all models, whether F1 follows from precision and recall and all lie in [0, 1] (areas only where
    the test rows have both classes); of those fitted to the decided label also whether F1 reaches 0.9 and the areas under both curves 0.97."""
    p, r, known = F.col("precision"), F.col("recall"), F.col("model") == "z_score"
    fine = F.abs(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)) - F.col("f1")) < 1e-9
    for name in ("accuracy", "precision", "recall"):
        fine = fine & F.col(name).between(0, 1)

    def rows_of(task):
        nothing_to_rank = split(spark, sf, task)[1].agg(F.min(LABEL) == F.max(LABEL)).scalar()
        # areas are sums of doubles; test rows of one class have none
        areas = reduce(lambda x, y: x & y, (F.coalesce(F.col(c).between(-1e-9, 1 + 1e-9), nothing_to_rank) for c in ("roc_auc", "pr_auc")))
        learned, ranks = F.col("f1") >= 0.9, (F.col("roc_auc") >= 0.97) & (F.col("pr_auc") >= 0.97)
        return compared(spark, sf, task)[0].select(
            "model", *(F.when(known, F.round(c, 6)).alias(c) for c in ("accuracy", "precision", "recall", "f1")),
            *(F.when(F.lit(task == "decided"), x).alias(c) for c, x in (("has_learned", learned), ("ranks_well", ranks))), (fine & areas).alias("consistent"))

    return both(rows_of)


def _runs(spark, sf):
    """The log of three trainings, an hour apart."""
    path = scratch_dir(spark, "runs")
    for hour, name in enumerate(["random_forest", "logistic_regression", "z_score"]):
        run = compared(spark, sf)[2].where(F.col("run_name") == name)
        files.append_runs(run.withColumn("started_at", F.lit(datetime(2024, 5, 1, 9 + hour, 30)).cast("timestamp")), path)
    return files.read_runs(spark, path)


@query("run_log", f"""WITH {Z_SQL}
SELECT run_name, params, hour, CASE WHEN run_name = 'z_score' THEN accuracy END AS accuracy, CASE WHEN run_name = 'z_score' THEN f1 END AS f1, true AS as_recomputed, 6 AS n_metrics
FROM scores, (VALUES ('z_score', 'z_threshold=2.0', 11), ('logistic_regression', 'C=1.0 max_iter=1000', 10),
  ('random_forest', 'max_depth=10 min_leaf=10 n_estimators=100', 9)) AS t(run_name, params, hour)""")
def run_log(spark, sf):
    """Names, parameters, times and metrics; the fitted models' logged metrics are those of their predictions, counted anew."""
    train, test = split(spark, sf)
    scored = models.zscore_baseline(train, test).select(F.lit("z_score").alias("run_name"), LABEL, "prediction")
    for name, model in compared(spark, sf)[1].items():
        scored = scored.unionByName(models.apply_model(model, test).select(F.lit(name).alias("run_name"), LABEL, "prediction"))
    y, p = F.col(LABEL) == 1, F.col("prediction") == 1
    counts = scored.groupBy("run_name").agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(y == p).alias("hit"), F.count("*").alias("n"))
    f1 = 2 * F.col("tp") / F.greatest(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(1))
    again = counts.select("run_name", (F.col("hit") / F.col("n")).alias("hit_rate"), f1.alias("f1_again"))
    logged = _runs(spark, sf).join(again, "run_name")
    params = F.array_sort(F.transform(F.map_entries("params"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    accuracy, f1 = F.col("metrics")["accuracy"], F.col("metrics")["f1"]
    known = F.col("run_name") == "z_score"
    return logged.select(
        "run_name", F.array_join(params, " ").alias("params"), F.hour("started_at").alias("hour"), F.when(known, F.round(accuracy, 6)).alias("accuracy"),
        F.when(known, F.round(f1, 6)).alias("f1"), ((F.abs(accuracy - F.col("hit_rate")) < 1e-9) & (F.abs(f1 - F.col("f1_again")) < 1e-9)).alias("as_recomputed"), F.size("metrics").alias("n_metrics"))


@query("latest_runs", "SELECT * FROM (VALUES ('z_score', 11), ('logistic_regression', 10)) AS t(run_name, hour)")
def latest_runs(spark, sf):
    """The two runs that began last; by name the forest would be among them."""
    return files.latest_runs(_runs(spark, sf), 2).select("run_name", F.hour("started_at").alias("hour"))


@query("scoring_throughput", f"""WITH {TASKS_SQL}
SELECT 'decided' AS task, count(*) AS rows, 120.0::DOUBLE AS allowed_seconds, true AS in_time, true AS consistent FROM marked
UNION ALL SELECT 'forecast', count(*), 120.0::DOUBLE, true, true FROM labelled""")
def scoring_throughput(spark, sf):
    """Rows scored, the time allowed and whether it was kept, and whether the rates belong to the seconds measured."""
    fine = (F.abs(F.col("rows_per_second") * F.col("seconds") - F.col("rows")) < 1e-3) & (F.abs(F.col("times_faster") * F.col("seconds") - 120) < 1e-6) & (F.col("seconds") > 0)

    def rows_of(task):
        speed = models.scoring_throughput(models.apply_model(forest(spark, sf, task), TASKS[task](spark, sf)))
        return speed.select("rows", "allowed_seconds", "in_time", fine.alias("consistent"))

    return both(rows_of)
