"""Chunks, running totals and ranks on skewed keys and values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators.ordered import cumulative, exact_quantiles, numbered, split_ordered


def skewed(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcdef"), n))
    value = np.where(rng.random(n) < 0.33, 7.0, np.round(rng.lognormal(0, 3, n), 3))
    return pd.DataFrame({"key": key, "value": value, "id": np.arange(n)})


@pytest.fixture(scope="module")
def data(spark):
    pdf = skewed()
    return pdf, spark.createDataFrame(pdf)


def test_chunks_are_bounded_and_ordered(spark, data):
    pdf, df = data
    split = split_ordered(df, ["key"], ["value", "id"], chunk_rows=100)
    got = split.assign(df).toPandas()
    sizes = got.groupby(["key", "_chunk"]).size()
    assert sizes.max() <= 100 and len(got) == len(pdf)
    for _, rows in got.groupby("key"):
        rows = rows.sort_values(["value", "id"])
        assert rows["_chunk"].is_monotonic_increasing


def test_equal_values_stay_together(spark, data):
    _, df = data
    got = split_ordered(df, ["key"], ["value"], chunk_rows=50).assign(df).toPandas()
    assert got.groupby(["key", "value"])["_chunk"].nunique().max() == 1


def test_halo(spark, data):
    _, df = data
    split = split_ordered(df, ["key"], ["value", "id"], chunk_rows=100)
    got = split.with_halo(df, rows_before=30, rows_after=2).toPandas()
    assert got["_own"].sum() == 3000
    for _, rows in got[got.key == "hot"].groupby("_chunk"):
        rows = rows.sort_values(["value", "id"])
        own = np.flatnonzero(rows["_own"])
        assert own[0] >= 30 or rows["_base"].iloc[0] == 0
        assert own[-1] - own[0] + 1 == len(own)


def test_numbered(spark, data):
    pdf, df = data
    got = numbered(df, ["key"], ["value", "id"], chunk_rows=70).toPandas().sort_values("id")
    expected = pdf.sort_values(["value", "id"]).groupby("key").cumcount() + 1
    assert list(got["rn"]) == list(expected.sort_index())


def test_whole_table_as_one_key(spark, data):
    pdf, df = data
    got = numbered(df, [], ["value", "id"], chunk_rows=70).toPandas().sort_values("id")
    order = pdf.sort_values(["value", "id"]).reset_index(drop=True).reset_index().sort_values("id")
    assert list(got["rn"]) == list(order["index"] + 1)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("chunk_rows", [None, 60])
def test_cumulative(spark, data, chunk_rows, descending):
    pdf, df = data
    got = cumulative(df, ["key"], "value", {"n": F.lit(1), "odd": F.col("id") % 2}, descending, chunk_rows).toPandas()
    for key, rows in got.groupby("key"):
        src = pdf[pdf.key == key].assign(n=1, odd=lambda d: d.id % 2)
        per = src.groupby("value")[["n", "odd"]].sum().sort_index(ascending=not descending)
        rows = rows.sort_values("value", ascending=not descending)
        assert list(rows["cum_n"]) == list(per["n"].cumsum())
        assert list(rows["cum_odd"]) == list(per["odd"].cumsum())
        assert set(rows["all_n"]) == {len(src)}
        nxt = rows.sort_values("value")
        assert list(nxt["next_value"].iloc[:-1]) == list(nxt["value"].iloc[1:])
        assert np.isnan(nxt["next_value"].iloc[-1])


@pytest.mark.parametrize("chunk_rows", [None, 40])
def test_quantiles_equal_numpy(spark, data, chunk_rows):
    pdf, df = data
    probs = {"q10": 0.1, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    got = exact_quantiles(df, ["key"], "value", probs, chunk_rows).toPandas().set_index("key")
    for key, rows in pdf.groupby("key"):
        for name, q in probs.items():
            assert got.loc[key, name] == pytest.approx(np.quantile(rows["value"], q))


def test_infinite_and_extreme_values(spark):
    values = [float("-inf"), -1e308, -1.0, 0.0, 1e-300, 1.0, 1e308, float("inf")] * 30
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value double, id long")
    got = numbered(df, [], ["value", "id"], chunk_rows=20).toPandas().sort_values(["value", "id"])
    assert list(got["rn"]) == list(range(1, len(values) + 1))


def test_null_and_only_one_value(spark):
    df = spark.createDataFrame([(None, 5)] * 300 + [("x", 1)], "key string, value long")
    got = cumulative(df, ["key"], "value", {"n": F.lit(1)}, chunk_rows=10).collect()
    assert sorted(r["cum_n"] for r in got) == [1.0, 300.0]


def test_large_keys_shuffle_only_wanted_chunks(spark, data):
    _, df = data
    split = split_ordered(df, [], ["value"], {"n": F.lit(1)}, chunk_rows=50)
    kept = split.assign(df, wanted=lambda n: [n // 2]).count()
    assert 0 < kept < 1200  # the value 7.0 alone holds a third of the rows


def untidy(spark, n=1200, seed=4):
    """Values with NULL, NaN, infinite ones and ties, a second order column with NULLs, one hot key."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        value = [None, float("nan"), float("inf"), float("-inf"), 7.0, float(np.round(rng.normal(), 2))][int(rng.choice(6, p=[.1, .1, .05, .05, .2, .5]))]
        rows.append((i, "hot" if rng.random() < 0.6 else "cold", value, None if rng.random() < 0.1 else int(rng.integers(0, 400)), int(rng.random() < 0.4)))
    return spark.createDataFrame(rows, "id long, key string, value double, tick long, label int")


@pytest.mark.parametrize("chunk_rows", [40, 90])
def test_cut_equals_uncut_for_untidy_values(spark, chunk_rows):
    from tickloom.operators import drift, evaluation, stats
    from tickloom.operators.ordered import values_at

    df = untidy(spark).cache()
    timed = df.withColumn("ts", F.timestamp_micros(F.col("tick") * 1_000_000))
    scored = df.select(F.col("label").alias("y_true"), F.col("value").alias("score"), "key")
    one, other = df.where("id % 2 = 0"), df.where("id % 2 = 1")

    def results(n):
        return {
            "numbered": numbered(df, ["key"], ["value", "id"], chunk_rows=n),
            "numbered by two": numbered(df, [], ["tick", "value", "id"], chunk_rows=n),
            "cumulative": cumulative(df, ["key"], "value", {"n": F.lit(1), "label": F.col("label")}, chunk_rows=n),
            "falling": cumulative(df, [], "value", {"n": F.lit(1)}, descending=True, chunk_rows=n),
            "values_at": values_at(df, ["key"], "value", {"a": lambda k: k // 3 if isinstance(k, int) else F.floor(k / 3)}, chunk_rows=n),
            "quantiles": exact_quantiles(df, ["key"], "value", {"q": 0.3}, chunk_rows=n),
            "differences": stats.time_differences(timed, "ts", "id", ["key"], chunk_rows=n),
            "rolling": stats.rolling_mean(timed, "value", "ts", "id", chunk_rows=n),
            "ks": drift.ks_test(one, other, ["value"], chunk_rows=n),
            "wasserstein": drift.wasserstein(one, other, ["value"], chunk_rows=n),
            "roc": evaluation.roc_auc(scored, ["key"], chunk_rows=n), "ap": evaluation.average_precision(scored, chunk_rows=n),
            "curve": evaluation.pr_curve(scored, chunk_rows=n),
        }

    def table(frame):
        columns = sorted(frame.columns)
        return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)]) for r in frame.collect())

    whole, cut = results(None), results(chunk_rows)
    for name in whole:
        assert table(cut[name]) == table(whole[name]), name


def test_null_comes_first_and_stays_together(spark):
    df = untidy(spark)
    got = split_ordered(df, ["key"], ["value", "id"], chunk_rows=40).assign(df).toPandas()
    for _, rows in got.groupby("key"):
        missing = rows["value"].isna() & ~rows["id"].isin([r["id"] for r in df.where("isnan(value)").collect()])
        assert rows[missing]["_chunk"].max() <= rows[~missing]["_chunk"].min()
        assert rows.groupby("_chunk").size().max() <= 40


def test_infinite_and_missing_values_are_cut_by_the_next_column(spark):
    values = [float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(values[i % 4], i) for i in range(2000)], "value double, id long")
    got = numbered(df, [], ["value", "id"], chunk_rows=30).toPandas()
    order = {None: 0, float("-inf"): 1, float("inf"): 2}
    rank = [3 if i % 4 == 0 else order[values[i % 4]] for i in got["id"]]
    assert list(got.assign(rank=rank).sort_values(["rank", "id"])["rn"]) == list(range(1, 2001))
    assert split_ordered(df, [], ["value", "id"], chunk_rows=30).assign(df).groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 30


def test_more_rows_than_small_chunks_can_hold(spark, data, monkeypatch):
    from tickloom.operators import ordered

    pdf, df = data
    monkeypatch.setattr(ordered, "MAX_CHUNKS", 3)
    split = split_ordered(df, [], ["value", "id"], chunk_rows=10)
    assert split.chunk_rows == -(-len(pdf) // 3)
    got = numbered(df, [], ["value", "id"], chunk_rows=10).toPandas().sort_values("id")
    order = pdf.sort_values(["value", "id"]).reset_index(drop=True).reset_index().sort_values("id")
    assert list(got["rn"]) == list(order["index"] + 1)


def ks_by_hand(a, b):
    grid = np.unique(np.concatenate([a, b]))
    return max(abs(np.mean(a <= x) - np.mean(b <= x)) for x in grid)


@pytest.mark.parametrize("shift", [0.0, 0.3])
def test_ks_is_exact_with_ties_and_shuffles_only_cells_that_may_hold_it(spark, shift):
    from tickloom.operators import drift

    rng = np.random.default_rng(8)
    a = np.concatenate([np.round(rng.normal(size=4000), 2), np.full(1500, 0.5)])
    b = np.concatenate([np.round(rng.normal(size=3000) + shift, 2), np.full(900, 0.5)])
    one, other = (spark.createDataFrame([(float(x),) for x in v], "x double") for v in (a, b))
    assert drift.ks_test(one, other, ["x"], chunk_rows=40).first()["statistic"] == pytest.approx(ks_by_hand(a, b), abs=1e-12)
    if shift:
        long = one.select("x", F.lit(1).alias("r"), F.lit(0).alias("c")).unionByName(other.select("x", F.lit(0).alias("r"), F.lit(1).alias("c")))
        split = split_ordered(long, [], ["x"], {"r": F.col("r"), "c": F.col("c")}, 40, refine=drift._may_hold_the_gap)
        assert split.assign(long, kept=drift._may_hold_the_gap).count() < 0.35 * long.count()
