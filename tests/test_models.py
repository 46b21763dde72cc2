"""Splits, baselines and classifiers on a separable sample."""

import numpy as np
import pandas as pd
import pytest

from tickloom.operators import models
from tickloom.schemas import FEATURES, LABEL


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    n = 600
    y = (rng.random(n) < 0.3).astype(int)
    pdf = pd.DataFrame({c: rng.normal(size=n) for c in FEATURES})
    pdf["volatility_60s"] = np.abs(rng.normal(0.01, 0.003, n)) + y * 0.05
    pdf[LABEL] = y
    pdf["seq"] = np.arange(n)
    return spark.createDataFrame(pdf).cache()


def test_split_sizes(spark, rows):
    counts = {(r[LABEL], r["split"]): r["count"]
              for r in models.stratified_split(rows, LABEL, "seq").groupBy(LABEL, "split").count().collect()}
    for label in (0, 1):
        total = counts[label, "train"] + counts[label, "test"]
        assert counts[label, "test"] == -(-total // 5)


def test_split_does_not_depend_on_chunks(spark, rows, monkeypatch):
    from tickloom.operators import ordered

    whole = {r["seq"] for r in models.stratified_split(rows, LABEL, "seq").where("split = 'test'").collect()}
    monkeypatch.setattr(ordered, "MIN_CHUNK_ROWS", 20)
    monkeypatch.setattr(ordered, "MAX_CHUNK_ROWS", 20)
    cut = {r["seq"] for r in models.stratified_split(rows, LABEL, "seq").where("split = 'test'").collect()}
    assert whole == cut


def test_zscore_baseline(spark, rows):
    pdf = rows.toPandas()
    got = models.zscore_baseline(rows, rows).toPandas().sort_values("seq")
    z = (pdf["volatility_60s"] - pdf["volatility_60s"].mean()) / pdf["volatility_60s"].std()
    np.testing.assert_allclose(got["z"], z.to_numpy(), rtol=1e-9)
    np.testing.assert_allclose(got["score"], (z / z.max()).to_numpy(), rtol=1e-9)


def test_train_compare_and_persistence(spark, rows, tmp_path):
    split = models.stratified_split(rows, LABEL, "seq")
    train, test = split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")
    metrics, fitted, runs = models.train_compare(train, test, trees=10, max_iter=50)
    by_model = {r["model"]: r for r in metrics.collect()}
    assert set(by_model) == {"z_score", "logistic_regression", "random_forest"}
    assert by_model["random_forest"]["pr_auc"] > 0.95 and by_model["z_score"]["roc_auc"] > 0.95
    assert runs.count() == 3 and runs.first()["metrics"]["f1"] is not None

    forest = fitted["random_forest"]
    assert models.feature_importance(spark, forest).first()["feature"] == "volatility_60s"
    models.save_model(forest, f"{tmp_path}/m")
    a = models.apply_model(forest, test).select("seq", "probability").toPandas().sort_values("seq")
    b = models.apply_model(models.load_model(f"{tmp_path}/m"), test).select("seq", "probability").toPandas()
    np.testing.assert_allclose(a["probability"], b.sort_values("seq")["probability"])

    speed = models.scoring_throughput(models.apply_model(forest, test)).first()
    assert speed["in_time"] and speed["allowed_seconds"] == 120.0


def test_forest_arrays_equal_mllib(spark, rows):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    model = models.fit_random_forest(rows, trees=20)
    holes = rows.withColumn("price", F.when(F.col("seq") % 7 != 0, F.col("price")))
    want = {r["seq"]: (r["p"], int(r["prediction"])) for r in model.transform(holes).withColumn("p", vector_to_array("probability")[1]).collect()}
    got = {r["seq"]: (r["probability"], r["prediction"]) for r in models.apply_model(model, holes).collect()}
    assert set(got) == set(want)
    for seq, (p, prediction) in want.items():
        assert got[seq][0] == pytest.approx(p, abs=1e-12) and (got[seq][1] == prediction or abs(p - 0.5) < 1e-12)


def test_rows_without_a_label_stay(spark, rows):
    from pyspark.sql import functions as F

    some = rows.withColumn(LABEL, F.when(F.col("seq") % 10 != 0, F.col(LABEL)))
    counts = {(r[LABEL], r["split"]): r["count"] for r in models.stratified_split(some, LABEL, "seq").groupBy(LABEL, "split").count().collect()}
    assert sum(counts.values()) == 600 and counts[None, "test"] == 12


def test_batch_skips_bad_rows(spark, rows):
    from pyspark.sql import functions as F

    model = models.fit_random_forest(rows, trees=3)
    some = rows.limit(20).withColumn("price", F.when(F.col("seq") % 2 == 0, F.col("price")))
    scored, rejected = models.predict_batch(model, some)
    assert scored.count() + rejected.count() == 20 and rejected.count() > 0


def test_variant_needs_a_model(spark, rows):
    with pytest.raises(ValueError):
        models.score_with_variant(rows, "ml")
    assert models.score_with_variant(rows, "baseline").first()["model_version"] == "baseline-1.0"


def walked(spark, model, rows, path):
    """P(spike) by walking the stored trees with joins in SQL: a row per (row, tree), one level at a time."""
    model.stages[-1].write().overwrite().save(path)
    spark.read.parquet(f"{path}/data").selectExpr(
        "treeID AS tree", "nodeData.id AS id", "nodeData.leftChild AS l", "nodeData.rightChild AS r", "nodeData.split.featureIndex AS f",
        "get(nodeData.split.leftCategoriesOrThreshold, 0) AS t", "nodeData.impurityStats AS s").createOrReplaceTempView("nodes")
    inputs = ", ".join(f"CAST({c} AS DOUBLE)" for c in model.stages[0].getInputCols())
    rows.selectExpr("seq", f"array({inputs}) AS x").createOrReplaceTempView("inputs")
    at = spark.sql("SELECT seq, x, tree, 0 AS id FROM inputs, (SELECT DISTINCT tree FROM nodes)")
    for _ in range(10):
        at.createOrReplaceTempView("at")
        at = spark.sql("SELECT seq, x, tree, CASE WHEN l < 0 THEN id WHEN x[f] <= t THEN l ELSE r END AS id FROM at JOIN nodes USING (tree, id)").cache()
    at.createOrReplaceTempView("at")
    return {r["seq"]: r["p"] for r in spark.sql("SELECT seq, avg(s[1] / (s[0] + s[1])) AS p FROM at JOIN nodes USING (tree, id) GROUP BY seq").collect()}


def test_forest_equals_a_walk_over_its_stored_trees(spark, rows, tmp_path):
    model = models.fit_random_forest(rows, trees=8)
    want = walked(spark, model, rows, f"{tmp_path}/trees")
    got = {r["seq"]: r["probability"] for r in models.apply_model(model, rows).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_importances_are_those_of_the_splits(spark, rows):
    model = models.fit_random_forest(rows, trees=8)
    want = {r["feature"]: r["importance"] for r in models.feature_importance(spark, model).collect()}
    got = {r["feature"]: r["importance"] for r in models.importance_of_trees(spark, model).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in got)


@pytest.mark.parametrize("broken", ["constant", "inverted", "permuted"])
def test_a_model_that_has_not_learned_turns_the_rows_red(spark, monkeypatch, broken):
    """The registered result differs from its SQL twin as soon as predictions do not come from the features."""
    import duckdb
    from pyspark.sql import functions as F

    from tests.conftest import SF
    from tests.test_registry import table_of
    from tickloom.plans import learning
    from tickloom.plans.catalog import QUERIES, SQL

    real = models.apply_model

    def apply_model(model, df):
        scored = real(model, df)
        if broken == "constant":
            return scored.withColumn("prediction", F.lit(1)).withColumn("probability", F.lit(0.9))
        if broken == "inverted":
            return scored.withColumn("prediction", 1 - F.col("prediction")).withColumn("probability", 1 - F.col("probability"))
        coin = F.pmod(F.xxhash64("seq"), F.lit(2)).cast("int")
        return scored.withColumn("prediction", coin).withColumn("probability", coin.cast("double"))

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    learning.compared(spark, SF)  # fitted as it should be
    monkeypatch.setattr(models, "apply_model", apply_model)
    for name in ("random_forest", "predict_batch", "score_with_variant_ml", "run_log"):
        df = QUERIES[name](spark, SF)
        twin = con.sql(SQL[name])
        assert table_of([tuple(r) for r in df.collect()], df.columns) != table_of(twin.fetchall(), twin.columns), name


def scored_rows(spark, sf, rows):
    from tickloom.plans import learning

    return {"all": learning.labelled(spark, sf).count(), "test": learning.split(spark, sf, "forecast")[1].count(), "models": 3, "summary": 1}[rows]


@pytest.mark.parametrize(("name", "rows"), [
    ("logistic_regression", "test"),
    ("random_forest", "test"),
    ("predict_batch", "all"),
    ("score_with_variant_ml", "all"),
    ("save_and_load_model", "all"),
    ("train_compare", "models"),
    ("scoring_throughput", "summary"),
])
def test_the_forecast_is_part_of_the_job(spark, name, rows):
    """Every row with a full horizon is fitted and scored with the label from its future; those of the decided label stand beside it."""
    from tests.conftest import SF
    from tickloom.plans.catalog import QUERIES

    df = QUERIES[name](spark, SF)
    assert "task" in df.columns
    tasks = [r["task"] for r in df.select("task").collect()]
    assert set(tasks) == {"forecast", "decided"} and tasks.count("forecast") == scored_rows(spark, SF, rows)


@pytest.mark.parametrize("broken", ["constant", "inverted", "permuted", "nudged"])
def test_the_scored_forecast_depends_on_its_model(spark, monkeypatch, broken):
    """score_with_variant_ml: the forecast's own rows differ from their SQL twin as soon as the scores are not those of a forest that has learned."""
    import duckdb
    from pyspark.sql import functions as F

    from tests.conftest import SF
    from tests.test_registry import table_of
    from tickloom.plans import learning
    from tickloom.plans.catalog import QUERIES, SQL

    def forecast():
        df = QUERIES["score_with_variant_ml"](spark, SF).where("task = 'forecast'")
        return table_of([tuple(r) for r in df.collect()], df.columns)

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    twin = con.sql(f"SELECT * FROM ({SQL['score_with_variant_ml']}) WHERE task = 'forecast'")
    expected = table_of(twin.fetchall(), twin.columns)
    assert forecast() == expected
    labels = {r["seq"]: r["volatility_spike"] for r in QUERIES["score_with_variant_ml"](spark, SF).where("task = 'forecast'").collect()}
    assert labels == {r["seq"]: r["volatility_spike"] for r in learning.labelled(spark, SF).collect()} and set(labels.values()) == {0, 1}

    real = models.apply_model

    def apply_model(model, df):
        p = F.col("probability")
        coin = F.pmod(F.xxhash64("seq"), F.lit(2)).cast("double")
        worse = {"constant": F.lit(0.1), "inverted": 1 - p, "permuted": coin, "nudged": p * 0.99}[broken]
        return real(model, df).withColumn("probability", worse).withColumn("prediction", (p > 0.5).cast("int"))

    monkeypatch.setattr(models, "apply_model", apply_model)
    assert forecast() != expected


@pytest.mark.parametrize("task", ["forecast", "decided"])
def test_every_scored_row_has_its_record(spark, task):
    """score_with_variant_ml: prediction, probability and class of all rows, the forecast's too, are returned and are those of MLlib."""
    from pyspark.ml.functions import vector_to_array

    from tests.conftest import SF
    from tickloom.plans import learning
    from tickloom.plans.catalog import QUERIES

    rows = learning.TASKS[task](spark, SF)
    walked = learning.forest(spark, SF, task).transform(rows).select("seq", LABEL, vector_to_array("probability")[1].alias("p"))
    expected = {r["seq"]: (r[LABEL], r["p"]) for r in walked.collect()}
    found = [r for r in QUERIES["score_with_variant_ml_records"](spark, SF).collect() if r["task"] == task]
    assert len(found) == rows.count() == len(expected) and len({r["probability"] for r in found}) > 1
    for r in found:
        label, p = expected[r["seq"]]
        assert r[LABEL] == label and abs(r["probability"] - p) < 0.5e-4 + 1e-9 and round(r["probability"], 4) == r["probability"]
        assert r["prediction"] == int(p > 0.5) or abs(p - 0.5) < 1e-9
        assert (r["class_label"], r["model_version"]) == ("spike" if r["prediction"] else "normal", "1.0")


@pytest.fixture(scope="module")
def calm(spark, tmp_path_factory):
    """Events whose swings bring volatility past DECIDED, but never to THRESHOLD: no row of the forecast is a spike."""
    from datetime import datetime, timedelta

    folder = str(tmp_path_factory.mktemp("calm"))
    swings = [33.0 if i // 150 % 3 == 0 else 4.0 for i in range(900)]
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=10 * i, seconds=i % 7), i % 5, ("click", "view")[i % 2], swing if i // 2 % 2 else -swing, f'{{"k": {i % 90}}}')
            for i, swing in enumerate(swings)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", [
    "logistic_regression",
    "predict_batch",
    "random_forest",
    "save_and_load_model",
    "score_with_variant_ml",
    "score_with_variant_ml_records",
    "scoring_throughput",
    "train_compare",
])
def test_a_forecast_without_spikes(spark, calm, name):
    """Models are fitted and rows scored where the label never is 1; the result is that of the SQL twin, and no spike is predicted."""
    import duckdb

    from tests.test_registry import table_of
    from tickloom.plans import learning
    from tickloom.plans.catalog import QUERIES, SQL

    assert [r[LABEL] for r in learning.labelled(spark, calm).select(LABEL).distinct().collect()] == [0]
    df = QUERIES[name](spark, calm)
    rows = [tuple(r) for r in df.collect()]
    if name in SQL:
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{calm}/events.parquet/*.parquet')")
        twin = con.sql(SQL[name])
        assert table_of(rows, df.columns) == table_of(twin.fetchall(), twin.columns)
    else:
        found = {(r["prediction"], r["probability"], r["class_label"]) for r in df.where("task = 'forecast'").collect()}
        assert found == {(0, 0.0, "normal")} and len(rows) == 1760


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_split_is_looked_for_once(spark, calm, monkeypatch):
    """run_log: train and test rows are read from one even table, not cut anew by each pass over them."""
    from tickloom.plans import learning

    monkeypatch.setattr(learning, "ROWS_PER_TASK", (100, 300), raising=False)
    path = f"file:{calm}"  # not split by other tests
    (train, test), again = learning.split(spark, path), learning.split(spark, path)
    assert "Join" not in optimized(train) + optimized(test) and set(train.inputFiles()) == set(again[0].inputFiles())
    sizes = [r["count"] for r in spark.read.parquet(*train.inputFiles()).groupBy("_metadata.file_name").count().collect()]
    assert len(sizes) > 1 and max(sizes) - min(sizes) <= len(sizes)
    assert sum(sizes) == train.count() + test.count() == learning.separable(spark, path).count()


def test_logged_metrics_are_worked_out_once(spark, calm):
    """latest_runs: appending a run to the log does not rank the scores of all models again."""
    from tickloom.plans import learning

    metrics, _, runs = learning.compared(spark, calm)
    assert not any(step in optimized(df) for df in (metrics, runs) for step in ("Window", "Aggregate"))
    assert {r["run_name"] for r in runs.collect()} == {"z_score", "logistic_regression", "random_forest"}
