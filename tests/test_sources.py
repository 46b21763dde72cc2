"""Parsing of raw messages, reports, the run log, replay."""

import json

import pytest
from pyspark.sql import functions as F

from tickloom.sources import files, ticks as raw

GOOD = {"type": "ticker", "product_id": "BTC-USD", "price": "42000.5", "time": "2024-01-01T00:00:00.123456Z",
        "best_bid": "42000", "best_ask": "42001"}
CASES = [
    (GOOD, None), (dict(GOOD, price=None), "price"), (dict(GOOD, price="abc"), "price"),
    (dict(GOOD, price="12f"), "price"), (dict(GOOD, time="yesterday"), "time"), (dict(GOOD, best_bid="x"), "best_bid"),
    (dict(GOOD, best_ask=None), "best_ask"), (dict(GOOD, price="nan"), None), (dict(GOOD, price=" 1e3 "), None),
    (dict(GOOD, price=17), None),
    ({k: v for k, v in GOOD.items() if k != "price"}, "price"), ({k: v for k, v in GOOD.items() if k != "time"}, "time"),
    ({k: v for k, v in GOOD.items() if not k.startswith("best")}, None), ("{broken", "invalid_json"),
]


def messages(spark):
    text = [(i, m if isinstance(m, str) else json.dumps(m)) for i, (m, _) in enumerate(CASES)]
    return spark.createDataFrame(text, "seq long, value string")


def test_rejection_cases(spark):
    got = {r["seq"]: r for r in raw.parse_ticks(messages(spark)).collect()}
    assert [got[i]["reason"] for i in range(len(CASES))] == [reason for _, reason in CASES]
    assert got[12]["bid"] == got[12]["ask"] == 42000.5  # absent quotes take the price
    assert got[0]["ts"].microsecond == 123456
    assert got[8]["price"] == 1000.0 and got[9]["price"] == 17.0


def test_ticker_filter(spark):
    m = spark.createDataFrame([(json.dumps(dict(GOOD, type=t)),) for t in ("ticker", "heartbeat")] + [("no json",)],
                              "value string")
    kept = raw.ticker_filter(m).collect()
    assert len(kept) == 1 and kept[0]["ingestion_timestamp"] is not None
    assert raw.undecodable(m).count() == 1


def test_absent_fields_read_as_not_available(spark):
    m = spark.createDataFrame([('{"product_id": "X"}',)], "value string")
    assert raw.message_fields(m).first().asDict() == {
        "product_id": "X", "price": "N/A", "time": "N/A", "volume_24h": "N/A"}


def test_replay_round_trip(spark):
    rows = [("A", i, 100.0 + i, 99.5, 100.5) for i in range(5)]
    t = spark.createDataFrame(rows, "symbol string, seq long, price double, bid double, ask double").withColumn(
        "ts", F.timestamp_micros(F.lit(1704067200000001) + F.col("seq") * 1_000_000))
    sent = raw.as_messages(raw.replay_ticks(t, max_ticks=3))
    back = raw.valid_ticks(sent).orderBy("seq").collect()
    assert [r["seq"] for r in back] == [0, 1, 2]
    assert back[0]["ts"].microsecond == 1 and back[2]["price"] == 102.0


def test_replay_delay(spark):
    t = spark.createDataFrame([(0, 0), (1, 4), (2, 6)], "seq long, s long").select(
        "seq", F.timestamp_seconds("s").alias("ts"))
    assert [r["delay"] for r in raw.replay_delay(t, 2.0).orderBy("seq").collect()] == [2.0, 1.0, 0.0]
    assert {r["delay"] for r in raw.replay_delay(t, 0).collect()} == {0.0}


def test_first_available(spark, tmp_path):
    files.write_csv_report(spark.createDataFrame([(1, "a")], "n int, s string"), f"{tmp_path}/b.csv")
    got = files.read_first_available(spark, [f"{tmp_path}/a.parquet", f"{tmp_path}/b.csv"])
    assert got.first()["s"] == "a"
    with pytest.raises(FileNotFoundError):
        files.read_first_available(spark, [f"{tmp_path}/none.parquet"])


def test_features_append_by_symbol_and_day(spark, tmp_path):
    f = spark.createDataFrame([("A", 1, 1.0), ("B", 2, 2.0)], "symbol string, seq long, price double").withColumn(
        "ts", F.timestamp_seconds(F.lit(1704067200)))
    files.write_features(f, f"{tmp_path}/f")
    files.write_features(f, f"{tmp_path}/f")
    back = spark.read.parquet(f"{tmp_path}/f")
    assert back.count() == 4 and {"symbol", "date"} <= set(back.columns)
    plan = back.where("symbol = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan


def test_run_log(spark, tmp_path):
    def run(name, second):
        return spark.createDataFrame([(name, {"trees": "10"}, {"f1": 0.5})],
                                     "run_name string, params map<string,string>, metrics map<string,double>").withColumn(
            "started_at", F.timestamp_seconds(F.lit(second)))

    for i in range(4):
        files.append_runs(run(f"r{i}", i), f"{tmp_path}/runs")
    runs = files.read_runs(spark, f"{tmp_path}/runs")
    assert runs.count() >= 2
    assert [r["run_name"] for r in files.latest_runs(runs).collect()] == ["r3", "r2", "r1"]
