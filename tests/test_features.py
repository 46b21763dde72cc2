"""Feature windows against a plain simulation of a bounded buffer, tick by tick."""

import datetime as dt
import random
from collections import deque
from dataclasses import replace
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from tickloom.operators import ordered
from tickloom.operators.features import asof_past_price, future_volatility, tick_features
from tickloom.operators.ordered import split_ordered
from tickloom.schemas import FEATURES, FeatureWindows

START = dt.datetime(2024, 1, 1)


def make_ticks(seed, n, symbols=("A", "B", "C"), hot=0.6, prices="walk"):
    rng = random.Random(seed)
    rows, now = [], 0.0
    price = dict.fromkeys(symbols, 100.0)
    for i in range(n):
        now += rng.choice([0, 0, 0.2, 1, 3, 10, 45])
        s = symbols[0] if rng.random() < hot else rng.choice(symbols[1:])
        if prices == "walk":
            price[s] *= 1 + rng.gauss(0, 0.002)
        else:
            price[s] = rng.choice([0.0, -1.0, 5.0, 7.5, 1e6, float("nan"), float("inf")])
        bid = price[s] - rng.choice([0, 0.01, 0.1])
        ask = price[s] + rng.choice([0, 0.02, -0.5])
        rows.append((s, i, START + dt.timedelta(seconds=now), price[s], bid, ask))
    return rows


def simulate(rows, w: FeatureWindows):
    out, buffers = [], {}
    for s, seq, ts, price, bid, ask in sorted(rows, key=lambda r: (r[2], r[1])):
        buffer = buffers.setdefault(s, deque(maxlen=w.buffer_size))
        previous = buffer[-1][0] if buffer else None
        first_two = len(buffer) == 1
        buffer.append((ts, price))
        if previous is None or (not first_two and previous == ts):
            continue
        ticks = list(buffer)
        row = {"symbol": s, "seq": seq, "price": price, "bid": bid, "ask": ask}
        for name, sec in w.returns.items():
            row[name] = 0.0
            for t, p in reversed(ticks):
                if (ts - t).total_seconds() >= sec:
                    row[name] = (price - p) / p * 100 if p > 0 else 0.0
                    break
        for name, sec in w.volatility.items():
            changes = [(b[1] - a[1]) / a[1] * 100 for a, b in zip(ticks, ticks[1:])
                       if (ts - b[0]).total_seconds() <= sec and a[1] > 0]
            with np.errstate(all="ignore"):
                row[name] = float(np.std(changes, ddof=1)) if len(changes) >= 2 else 0.0
        row["spread"] = (ask - bid) / price * 100 if price > 0 and ask >= bid else 0.0
        for name, sec in w.intensity.items():
            n = sum((ts - t).total_seconds() <= sec for t, _ in ticks)
            row[name] = n / sec if n >= 2 else 0.0
        out.append(row)
    return pd.DataFrame(out)


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "symbol string, seq long, ts timestamp, price double, bid double, ask double")


def compare(actual: pd.DataFrame, expected: pd.DataFrame, rtol=1e-7, atol=1e-9):
    actual = actual.sort_values(["symbol", "seq"]).reset_index(drop=True)
    expected = expected.sort_values(["symbol", "seq"]).reset_index(drop=True)
    assert list(actual["seq"]) == list(expected["seq"])
    for c in FEATURES:
        np.testing.assert_allclose(actual[c].to_numpy(), expected[c].to_numpy(), rtol=rtol, atol=atol, err_msg=c)


@pytest.mark.parametrize("chunk_rows", [None, 40])
@pytest.mark.parametrize("buffer_size", [500, 8, 2])
def test_equals_simulation(spark, buffer_size, chunk_rows):
    w = FeatureWindows().scaled(1, buffer_size)
    rows = make_ticks(buffer_size, 700)
    compare(tick_features(frame(spark, rows), w, chunk_rows).toPandas(), simulate(rows, w))


@pytest.mark.parametrize("chunk_rows", [None, 60])
def test_odd_prices(spark, chunk_rows):
    """Zero, negative, NaN and infinite prices leave the window without a trace.

    Returns here reach 10^7 %; sums of squares resolve a deviation down to 10^-8 of the returns it is taken over.
    """
    w = FeatureWindows().scaled(1, 20)
    rows = make_ticks(3, 500, prices="odd")
    compare(tick_features(frame(spark, rows), w, chunk_rows).toPandas(), simulate(rows, w), rtol=1e-5, atol=1e-5)


def test_one_hot_time(spark):
    """A third of all ticks carry one and the same time: they are cut apart by arrival number."""
    rows = make_ticks(5, 300)
    middle = rows[150][2]
    rows += [("A", 1000 + i, middle, 100 + i % 7 * 0.1, 99.0, 101.0) for i in range(150)]
    w = FeatureWindows().scaled(1, 30)
    compare(tick_features(frame(spark, rows), w, 25).toPandas(), simulate(rows, w))


def test_outlier_does_not_blur_small_moves(spark):
    """A move of 10^7 % next to moves of 10^-4 %: sums of the window after it stay exact."""
    price = [100.0] * 5 + [1e7] + [100 + 1e-4 * (i % 3) for i in range(300)]
    rows = [("A", i, START + dt.timedelta(seconds=i), p, p, p) for i, p in enumerate(price)]
    w = FeatureWindows()
    compare(tick_features(frame(spark, rows), w).toPandas(), simulate(rows, w))


def test_intensity_is_capped_by_the_buffer(spark):
    """500 / 30, 500 / 60, 500 / 120."""
    rows = [("A", i, START + dt.timedelta(milliseconds=10 * i), 100.0, 100.0, 100.0) for i in range(2500)]
    got = tick_features(frame(spark, rows), chunk_rows=600).agg(
        {"intensity_30s": "max", "intensity_60s": "max", "intensity_120s": "max"}).first()
    assert sorted(round(x, 3) for x in got) == [4.167, 8.333, 16.667]


def test_plan_has_one_shuffle_and_one_sort(spark):
    for chunk_rows in (None, 40):
        df = tick_features(frame(spark, make_ticks(1, 300)), chunk_rows=chunk_rows)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("Sort [") == 1
        assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("chunk_rows", [None, 40])
@pytest.mark.parametrize("prices", ["walk", "odd"])
def test_without_a_limit_on_the_buffer(spark, chunk_rows, prices):
    w = replace(FeatureWindows(), buffer_size=None)
    rows = make_ticks(21, 600, prices=prices)
    rows += [("B", 5000 + i, START + dt.timedelta(days=2, seconds=i // 3), 90.0 + i % 5, 90.0, 91.0) for i in range(200)]  # prices of before a long silence
    tolerance = {} if prices == "walk" else {"rtol": 1e-5, "atol": 1e-5}
    compare(tick_features(frame(spark, rows), w, chunk_rows).toPandas(), simulate(rows, w), **tolerance)


def test_unlimited_history_copies_the_longest_window_only(spark):
    """Of all that is older than the window, and than the slices it reaches into, each chunk gets one row."""
    ticks = spark.range(4000).select(F.lit("A").alias("symbol"), (F.col("id") * 10).alias("us"), F.col("id").alias("seq"))
    split = split_ordered(ticks, ["symbol"], ["us", "seq"], chunk_rows=400, track_last=True)
    copied = split.with_halo(ticks, span_before=500).where("not _own").groupBy("_chunk").agg(
        F.count("*").alias("n"), F.min("us").alias("oldest"), F.min("_base").alias("base"))
    own = split.with_halo(ticks, span_before=500).where("_own").groupBy("_chunk").agg(F.min("us").alias("begin"), F.min("_base").alias("base"))
    rows = copied.join(own.drop("base"), "_chunk").collect()
    assert len(rows) > 8
    for r in rows:
        assert 50 < r["n"] <= 50 + 400 // 16 + 2 and r["oldest"] < r["begin"] - 500 and r["base"] == r["oldest"] // 10


def test_past_prices_of_any_age(spark):
    rows = make_ticks(31, 300)
    for chunk_rows in (None, 25):
        got = {(r["symbol"], r["seq"]): r["past_price"] for r in asof_past_price(frame(spark, rows), 30, None, chunk_rows).collect()}
        by_symbol = {}
        for s, seq, ts, price, *_ in sorted(rows, key=lambda r: (r[2], r[1])):
            ticks = by_symbol.setdefault(s, [])
            ticks.append((ts, price))
            if (s, seq) in got:
                old = [p for t, p in ticks if t <= ts - dt.timedelta(seconds=30)]
                assert got[s, seq] == (old[-1] if old else None)


def test_more_rows_than_chunks_of_the_usual_size(spark, monkeypatch):
    """With three chunks at most the table is cut into larger ones; nothing is refused."""
    monkeypatch.setattr(ordered, "MAX_CHUNKS", 3)
    rows = make_ticks(41, 500)
    w = FeatureWindows().scaled(1, 20)
    compare(tick_features(frame(spark, rows), w, 10).toPandas(), simulate(rows, w))
    check_future_volatility(spark, rows, 10)


def test_totals_over_many_chunks_are_exact(spark):
    """Returns from 10^7 % down to 10^-6 %: the sum over all chunks is that of exact fractions, rounded once."""
    from tickloom.operators import features

    rng = random.Random(51)
    price, rows = 100.0, []
    for i in range(900):
        price *= rng.choice([1 + 1e-8, 1 - 1e-8, 1.5, 1 / 1.5, 1e5, 1e-5])
        price = min(max(price, 1e-6), 1e9)
        rows.append(("A", i, START + dt.timedelta(seconds=i), price, price, price))
    base, split = features._split_ticks(frame(spark, rows), 20)
    assert split.groups and max(s.chunk for s in next(iter(split.groups.values()))) > 40
    own, _ = features._ranked(frame(spark, rows), 1, 20)
    known = features._running_totals(own.where("_own").withColumn("_next_us", F.lit(0)), split)
    width = Fraction(1 << 30)
    changes = [None] + [(b[3] - a[3]) / a[3] * 100 for a, b in zip(rows, rows[1:])]
    exact, squares = Fraction(0), Fraction(0)
    by_seq = {r["seq"]: r for r in known.select("seq", "_e", "_tot").collect()}
    for i, change in enumerate(changes):
        if change is not None:
            exact, squares = exact + Fraction(change), squares + Fraction(change * change)
        t, e = by_seq[i]["_tot"], int(by_seq[i]["_e"])
        for value, moment, top, scale in ((exact, "r", "_rt", e), (squares, "q", "_qt", 2 * e)):
            limbs = ((Fraction(t[top]) * width + t[f"_{moment}0"]) * width + t[f"_{moment}1"]) * width + t[f"_{moment}2"]
            assert abs(limbs * Fraction(2) ** (scale - 90) - value) <= (i + 1) * Fraction(2) ** (scale - 90)


@pytest.mark.parametrize("chunk_rows", [None, 30])
def test_future_volatility(spark, chunk_rows):
    check_future_volatility(spark, make_ticks(11, 400), chunk_rows)


def check_future_volatility(spark, rows, chunk_rows):
    got = {(r["symbol"], r["ts"]): r for r in
           future_volatility(frame(spark, rows), 60, 0.1, chunk_rows).collect()}
    end = max(r[2] for r in rows)
    by_symbol = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        by_symbol.setdefault(r[0], []).append(r)
    assert len(got) == len({(r[0], r[2]) for r in rows})
    for s, ticks in by_symbol.items():
        for _, _, ts, *_ in ticks:
            ahead = [r[3] for r in ticks if ts < r[2] <= ts + dt.timedelta(seconds=60)]
            moves = pd.Series(ahead).pct_change().dropna() * 100 if ahead else pd.Series(dtype=float)
            sigma = float(moves.std()) if len(moves) >= 2 else 0.0
            row = got[s, ts]
            assert row["future_volatility"] == pytest.approx(sigma, abs=1e-8)
            assert row["complete"] == (ts + dt.timedelta(seconds=60) <= end)


def test_empty_input(spark):
    assert tick_features(frame(spark, [])).count() == 0
