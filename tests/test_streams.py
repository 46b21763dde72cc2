"""The stream yields what the batch yields, across micro-batches and restarts."""

import datetime as dt
import json
import os
import time
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_features import compare, frame, make_ticks, simulate
from tickloom.operators import models, slo
from tickloom.operators.features import tick_features
from tickloom.schemas import FEATURES, LABEL, FeatureWindows
from tickloom.sources import ticks as raw
from tickloom.sources.versions import ModelVersions
from tickloom.streaming import features as live, jobs, watch

WINDOWS = FeatureWindows().scaled(1, 20)


def write_batches(spark, rows, path, sizes):
    at = 0
    for n in sizes:
        frame(spark, rows[at:at + n]).coalesce(1).write.mode("append").parquet(path)
        at += n


def stream_of(spark, path):
    schema = frame(spark, make_ticks(1, 2)).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, path, out, state):
    live.use_rocksdb(spark)
    jobs.run_available(jobs.append_table(live.stream_tick_features(stream_of(spark, path), WINDOWS), out), state)
    return spark.read.parquet(out)


def test_stream_equals_batch_over_restart(spark, tmp_path):
    rows = make_ticks(21, 240)
    path, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    write_batches(spark, rows[:150], path, [1, 70, 79])
    run(spark, path, out, state)
    write_batches(spark, rows[150:], path, [90])  # the buffer comes back from the checkpoint
    streamed = run(spark, path, out, state).toPandas()
    compare(streamed, simulate(rows, WINDOWS))
    batch = tick_features(frame(spark, rows), WINDOWS).toPandas()
    key = ["symbol", "seq"]
    np.testing.assert_allclose(streamed.sort_values(key)[FEATURES], batch.sort_values(key)[FEATURES], rtol=1e-7, atol=1e-9)


def test_counters_and_rejected_rows(spark, tmp_path):
    good = {"type": "ticker", "product_id": "A", "price": "1", "time": "2024-01-01T00:00:00Z"}
    lines = [json.dumps(good)] * 3 + ["broken", json.dumps(dict(good, price="x"))]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_path}/in")
    stream = raw.read_tick_stream(spark, "text", path=f"{tmp_path}/in")
    writer = jobs.consume_with_checkpoint(stream, f"{tmp_path}/ticks", f"{tmp_path}/counters")
    jobs.run_available(writer, f"{tmp_path}/state")
    row = spark.read.parquet(f"{tmp_path}/counters").first()
    assert (row["received"], row["processed"], row["failed"]) == (5, 3, 2)
    assert spark.read.parquet(f"{tmp_path}/ticks").count() == 3


def test_stream_score_uses_the_rules(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0.08, 0.09, 0.03, 280.0), (2, 0.0, 0.0, 0.0, 0.0)],
                                 "seq long, volatility_30s double, volatility_60s double, return_60s double, "
                                 "intensity_60s double")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    jobs.run_available(jobs.append_table(jobs.stream_score(stream), f"{tmp_path}/out"), f"{tmp_path}/state")
    got = {r["seq"]: r for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got[1]["class_label"] == "spike" and got[2]["class_label"] == "normal"
    assert got[1]["model_version"] == "baseline-1.0"


def test_paced_query_stops(spark, tmp_path):
    write_batches(spark, make_ticks(2, 5), f"{tmp_path}/in", [5])
    writer = jobs.append_table(stream_of(spark, f"{tmp_path}/in"), f"{tmp_path}/out")
    query = jobs.paced(writer, f"{tmp_path}/state", "1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


@pytest.mark.parametrize("seconds", [30])
def test_sessions_end_in_silence(spark, tmp_path, seconds):
    from pyspark.sql import functions as F

    times = [0, 10, 20, 100, 110, 1000]
    t = spark.createDataFrame([(s,) for s in times], "s long").select(
        F.lit("A").alias("symbol"), F.timestamp_seconds("s").alias("ts"))
    t.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(t.schema).parquet(f"{tmp_path}/in")
    jobs.run_available(jobs.append_table(jobs.feed_sessions(stream, f"{seconds} seconds"), f"{tmp_path}/out"),
                       f"{tmp_path}/state")
    got = sorted(r["ticks"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [2, 3]


def test_a_new_checkpoint_keeps_stored_rows(spark, tmp_path):
    """Batch numbers start again with a new checkpoint; the folders do not meet."""
    live.use_rocksdb(spark)
    rows = make_ticks(5, 30)
    for i, part in enumerate((rows[:20], rows[20:])):
        write_batches(spark, part, f"{tmp_path}/in{i}", [len(part)])
        writer = jobs.dual_sink(stream_of(spark, f"{tmp_path}/in{i}").withColumn("ts", F.col("ts").cast("timestamp")), f"{tmp_path}/table", lambda *_: None)
        jobs.run_available(writer, f"{tmp_path}/state{i}")
    assert spark.read.parquet(f"{tmp_path}/table").count() == 30


def test_event_time_order(spark, tmp_path):
    """Shuffled arrival within the watermark gives the rows of ordered arrival, up to the watermark."""
    live.use_rocksdb(spark)
    rows = make_ticks(31, 200)
    span = (max(r[2] for r in rows) - min(r[2] for r in rows)).total_seconds()
    shuffled = sorted(rows, key=lambda r: (r[2].timestamp() + (r[1] * 37 % 11) / 11 * span / 8, r[1]))
    last = (rows[0][0], 10_000, max(r[2] for r in rows) + dt.timedelta(days=2), *rows[0][3:])
    write_batches(spark, [*shuffled, last], f"{tmp_path}/in", [40, 40, 40, 80, 1])
    stream = live.stream_tick_features(stream_of(spark, f"{tmp_path}/in"), WINDOWS, watermark=f"{int(span / 4)} seconds")
    jobs.run_available(jobs.append_table(stream, f"{tmp_path}/out"), f"{tmp_path}/state")
    got = spark.read.parquet(f"{tmp_path}/out").toPandas()
    compare(got, simulate(rows, WINDOWS))


def late_stream(spark, path):
    return live.stream_tick_features(stream_of(spark, path), WINDOWS, watermark="60 seconds", tag_late=True)


def test_late_ticks_and_features_account_for_every_tick(spark, tmp_path):
    """Ticks in four deliveries, some of them long after their time: each is late, or has its part in the features."""
    live.use_rocksdb(spark)
    rows = make_ticks(61, 300)
    path, out, late, state = (f"{tmp_path}/{n}" for n in ("in", "out", "late", "state"))
    held = [r for r in rows if r[1] % 11 == 0]
    rest = [r for r in rows if r[1] % 11]
    end = [("-", 9999, max(r[2] for r in rows) + dt.timedelta(hours=1), 1.0, 1.0, 1.0)]
    for part in (rest[:150], held[:10] + rest[150:], end, held[10:]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(path)
        jobs.run_available(jobs.split_late(late_stream(spark, path), out, late), state)
    tagged = {r["seq"] for r in spark.read.parquet(late).collect()}
    assert tagged and tagged <= {r[1] for r in held}
    in_time = [r for r in rows if r[1] not in tagged]
    compare(spark.read.parquet(out).toPandas(), simulate(in_time, WINDOWS))
    newest = {}
    for r in rest:
        newest[r[0]] = max(newest.get(r[0], r[2]), r[2])
    assert {r[1] for r in held[10:] if r[2] < newest[r[0]]} <= tagged
    kept = {r["seq"]: r["price"] for r in spark.read.parquet(late).collect()}
    assert all(kept[r[1]] == r[3] for r in held if r[1] in tagged)


def test_late_needs_a_watermark(spark, tmp_path):
    frame(spark, make_ticks(1, 3)).write.parquet(f"{tmp_path}/in")
    with pytest.raises(ValueError, match="watermark"):
        live.stream_tick_features(stream_of(spark, f"{tmp_path}/in"), WINDOWS, tag_late=True)


def wait_for(what, seconds=90):
    deadline = time.monotonic() + seconds
    while time.monotonic() < deadline:
        if found := what():
            return found
        time.sleep(0.5)
    raise AssertionError("nothing came")


def test_a_silent_feed_is_reported_while_it_is_silent(spark, tmp_path):
    live.use_rocksdb(spark)
    path, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def send(symbol, seq):
        frame(spark, [(symbol, seq, dt.datetime(2024, 1, 1, 0, 0, seq), 1.0, 1.0, 1.0)]).coalesce(1).write.mode("append").parquet(path)

    def alerts():
        if not os.path.isdir(f"{out}/_spark_metadata"):
            return []
        return sorted(tuple(r) for r in spark.read.schema(watch.ALERT).parquet(out).select("symbol", "event").collect())

    send("A", 1)
    query = jobs.paced(jobs.append_table(watch.watch_feed(stream_of(spark, path), 2.0), out), f"{tmp_path}/state", "1 second")
    try:
        assert wait_for(alerts) == [("A", "stale")]  # no further tick has come
        send("A", 2)
        assert wait_for(lambda: len(alerts()) >= 2 and alerts())[:2] == [("A", "recovered"), ("A", "stale")]
        assert wait_for(lambda: len(alerts()) >= 3 and alerts()) == [("A", "recovered"), ("A", "stale"), ("A", "stale")]
    finally:
        query.stop()
    rows = spark.read.parquet(out).where("event = 'stale'").collect()
    assert all(2.0 <= r["silent_seconds"] < 60 for r in rows) and {r["last_tick"].second for r in rows} == {1, 2}


def test_lag_of_a_running_stream(spark, tmp_path):
    """Three files at one a batch: the snapshots of the query's progress show its lag fall from two files' rows to none."""
    path, table = f"{tmp_path}/in", f"{tmp_path}/snapshots"
    write_batches(spark, make_ticks(71, 60), path, [20, 20, 20])
    listener = watch.ProgressSnapshots(spark, table, lambda topic: 60)
    spark.streams.addListener(listener)
    try:
        query = jobs.append_table(stream_of(spark, path), f"{tmp_path}/out").queryName("lagging").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        wait_for(lambda: os.path.isdir(table) and watch.read_snapshots(spark, table).count() >= 3)
    finally:
        spark.streams.removeListener(listener)
    snapshots = watch.read_snapshots(spark, table).orderBy("batch_id").collect()
    assert [(r["consumer_offset"], r["log_end_offset"], r["rows"]) for r in snapshots[:3]] == [(20, 60, 20), (40, 60, 20), (60, 60, 20)]
    early = watch.read_snapshots(spark, table).where("batch_id < 2")
    assert slo.consumer_lag(*watch.stream_offsets(early)).first()["lag"] == 20
    assert slo.lag_by_topic(slo.consumer_lag(*watch.stream_offsets(watch.read_snapshots(spark, table)))).first()["total_lag"] == 0


def test_progress_of_sources_with_partitions(spark, tmp_path):
    source = SimpleNamespace(description="Kafka[Subscribe[ticks.raw]]", endOffset='{"ticks.raw":{"0":15,"1":20}}', latestOffset='{"ticks.raw":{"0":18,"1":20}}', numInputRows=9)
    other = SimpleNamespace(description="FileSource", endOffset='{"logOffset":3}', latestOffset=None, numInputRows=4)
    progress = SimpleNamespace(id="q", name=None, batchId=7, timestamp="2024-01-01T00:00:00.000Z", sources=[source, other])
    rows = watch.ProgressSnapshots(spark, f"{tmp_path}/none").rows_of(progress)
    assert [r[4:] for r in rows] == [("ticks.raw", 0, 15, 18, 9), ("ticks.raw", 1, 20, 20, 9), ("FileSource", 0, 4, 4, 4)]


def refuses_sevens(batch):
    values = batch.column("value").to_pylist()
    if any(v == "boom" for v in values):
        raise RuntimeError("boom")
    return ["a seven" if v == "7" else None for v in values]


def test_failing_messages_stop_nothing_and_are_kept_once(spark, tmp_path):
    path, done, dead, state = (f"{tmp_path}/{n}" for n in ("in", "done", "dead", "state"))

    def send(values, first):
        rows = [(v, "ticks", 0, first + i) for i, v in enumerate(values)]
        spark.createDataFrame(rows, "value string, topic string, partition int, offset long").coalesce(1).write.mode("append").parquet(path)

    def run_once():
        stream = spark.readStream.schema("value string, topic string, partition int, offset long").option("maxFilesPerTrigger", 1).parquet(path)
        jobs.run_available(jobs.consume_with_handler(stream, refuses_sevens, done, dead), state)

    send(["1", "boom", "7", "2"], 0)
    run_once()
    # the last batch was written but not committed: it is repeated after the restart
    os.remove(f"{state}/commits/0")
    for name in os.listdir(f"{state}/commits"):
        if name.startswith(".0"):
            os.remove(f"{state}/commits/{name}")
    send(["3", "boom"], 4)
    run_once()
    letters = {r["offset"]: r["reason"] for r in jobs.read_dead_letters(spark, dead).collect()}
    assert letters == {1: "RuntimeError: boom", 2: "a seven", 5: "RuntimeError: boom"} and jobs.read_dead_letters(spark, dead).count() == 3
    assert sorted(r["offset"] for r in spark.read.parquet(done).collect()) == [0, 3, 4]
    jobs.replay_dead_letters(spark, dead, lambda batch: ["still" if v == "7" else None for v in batch.column("value").to_pylist()], done, f"{tmp_path}/still")
    assert sorted(r["offset"] for r in spark.read.parquet(done).collect()) == [0, 1, 3, 4, 5]
    assert [(r["offset"], r["reason"]) for r in jobs.read_dead_letters(spark, f"{tmp_path}/still").collect()] == [(2, "still")]


def test_a_stream_takes_the_version_in_force(spark, tmp_path):
    """Rules, a stored forest, and a rollback to the rules while one query runs: each batch bears its version and that one's scores."""
    rng = np.random.default_rng(9)

    def rows(first):
        return [("A", first + i, *map(float, rng.normal(size=len(FEATURES)))) for i in range(40)]

    schema = "symbol string, seq long, " + ", ".join(f"{c} double" for c in FEATURES)
    first, second, third = (spark.createDataFrame(rows(i * 100), schema) for i in range(3))
    labelled = first.withColumn(LABEL, (F.col("volatility_60s") > 0).cast("int"))
    model = models.fit_random_forest(labelled, trees=5)
    models.save_model(model, f"{tmp_path}/model")
    versions = ModelVersions(f"{tmp_path}/versions")
    path, out = f"{tmp_path}/in", f"{tmp_path}/out"
    versions.put_in_force(spark, "rules-1", "baseline")
    first.coalesce(1).write.parquet(path)
    query = jobs.paced(jobs.score_versions(spark.readStream.schema(schema).parquet(path), versions, out), f"{tmp_path}/state", "1 second")

    def scored():
        return {r["seq"]: (r["model_version"], r["probability"]) for r in spark.read.schema("seq long, model_version string, probability double").parquet(out).collect()} if os.path.isdir(out) else {}

    try:
        wait_for(lambda: len(scored()) == 40)
        versions.put_in_force(spark, "forest-1", "ml", f"{tmp_path}/model")
        second.coalesce(1).write.mode("append").parquet(path)
        wait_for(lambda: len(scored()) == 80)
        versions.put_in_force(spark, "rules-1")
        third.coalesce(1).write.mode("append").parquet(path)
        wait_for(lambda: len(scored()) == 120)
        assert query.isActive
    finally:
        query.stop()
    want = {}
    for part, (name, variant) in zip((first, second, third), (("rules-1", "baseline"), ("forest-1", "ml"), ("rules-1", "baseline"))):
        for r in models.score_with_variant(part, variant, model).collect():
            want[r["seq"]] = (name, r["probability"])
    assert scored() == want
    assert [r["version"] for r in versions.decisions(spark).orderBy("place").collect()] == ["rules-1", "forest-1", "rules-1"]
    with pytest.raises(ValueError, match="no stored model"):
        versions.put_in_force(spark, "unheard-of")


class _Held:
    """Stands in for Spark's state: a handle, its timers and its variables, which note the most ticks that a value held."""

    def __init__(self):
        self.states, self.timers, self.most = {}, set(), 0

    def getListState(self, name, *schemas):
        return self.states.setdefault(name, _Value(self))

    getMapState = getValueState = getListState

    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


class _Value:
    def __init__(self, held):
        self.held, self.value, self.map = held, None, {}

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def put(self, rows):
        self.held.most, self.value = max(self.held.most, len(rows)), rows

    update = put

    def clear(self):
        self.value = None

    def keys(self):
        return iter([*self.map])

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.held.most = max(self.held.most, len(value[0]) // 40)
        self.map[key] = value

    def removeKey(self, key):
        del self.map[key]


class _Until:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


@pytest.mark.parametrize("tag_late", [False, True], ids=["stream_in_event_time", "stream_late_ticks"])
@pytest.mark.parametrize("batches", [1, 3, 400])
def test_waiting_ticks_are_held_in_bounded_blocks(tag_late, batches, monkeypatch):
    """Out-of-order ticks of any number wait in values of bounded size and come out in pieces, as if they had come in order at once."""
    import pandas as pd

    for name, rows in (("_RUN_ROWS", 1024), ("_BLOCK_ROWS", 64)):
        monkeypatch.setattr(live, name, rows, raising=False)
    rng = np.random.default_rng(5)
    n, windows = 6000, FeatureWindows().scaled(1, 60)
    us = np.sort(rng.integers(0, 900, n)) * 1_000_000 + 1_700_000_000_000_000  # about seven ticks a time
    us[100:800] = us[100]  # a burst longer than a block and the buffer
    frame = pd.DataFrame({"ts": us.astype("datetime64[us]"), "seq": np.arange(n), "price": 100 + rng.normal(0, 1, n).cumsum() / 50, "bid": 99.0, "ask": 101.0})

    def emitted(deliveries, held):
        buffer, out = live.TickBuffer(windows, True, tag_late), []
        buffer.init(held)
        for rows, watermark in deliveries:
            if rows is None:
                out += buffer.handleExpiredTimer(("s",), _Until(watermark), None)
            else:
                out += buffer.handleInputRows(("s",), iter([rows.iloc[i:i + 250] for i in range(0, len(rows), 250)]), _Until(watermark))
        assert not held.timers
        return out

    mixed, held = frame.sample(frac=1, random_state=3), _Held()
    last = int(us[-1] // 1000)
    if batches == 1:
        deliveries = [(mixed, 0), (None, last)]
    else:  # ticks are up to an eighth of the time late; the watermark follows behind
        arrives = mixed["ts"].astype("int64") + rng.integers(0, 100_000_000, n)
        parts = np.array_split(mixed.iloc[np.argsort(arrives.to_numpy(), kind="stable")], batches)
        newest = np.maximum.accumulate([0, *(int(p["ts"].astype("int64").max() // 1000) for p in parts)])
        deliveries = [(p, max(0, int(m) - 101_000)) for p, m in zip(parts, newest)] + [(None, last)]
    found = emitted(deliveries, held)
    assert max(len(x) for x in found) <= 1024 and held.most <= 64
    one = _Held()
    whole = pd.concat(emitted([(frame, last)], one)).reset_index(drop=True)
    pd.testing.assert_frame_equal(pd.concat(found).reset_index(drop=True), whole, check_dtype=False, rtol=0, atol=1e-9)
    # and as one timeline gives them
    columns = live.TickBuffer._columns(frame)
    wanted = np.flatnonzero(np.concatenate([[False], us[1:] != us[:-1]]) | (np.arange(n) == 1))
    expected = live.features_at(*(columns[i] for i in (0, 2, 3, 4)), wanted, windows)
    assert whole["seq"].tolist() == wanted.tolist()
    for name, values in expected.items():
        np.testing.assert_allclose(whole[name], values, rtol=0, atol=1e-9)
