"""Features per tick on a stream, from a keyed tick buffer that survives restarts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.schemas import FEATURE_ROW, FeatureWindows

_MICROS = 1_000_000
_TICK = "us bigint, seq bigint, price double, bid double, ask double"
_TICK_BYTES = 5 * 8
#: Waiting ticks are sorted a run at a time and held in blocks, each keyed by its first tick.
_RUN_ROWS, _BLOCK_ROWS = 1 << 19, 1 << 12
_BLOCK = "us bigint, seq bigint, run bigint, place int, size int"
#: So many blocks that are less than half full are merged.
_SMALL_BLOCKS = 64
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def features_at(us: np.ndarray, price: np.ndarray, bid: np.ndarray, ask: np.ndarray, wanted: np.ndarray, windows: FeatureWindows) -> dict[str, np.ndarray]:
    """The 13 features of the ticks at places ``wanted`` of a timeline in (time, arrival) order, by searches and prefix sums.

    Sums run in extended precision over returns less their mean; an infinite return makes the windows that hold it NaN.
    """
    size = windows.buffer_size
    with np.errstate(divide="ignore", invalid="ignore"):
        change = (price[1:] - price[:-1]) / price[:-1] * 100
    usable = np.concatenate([[False], price[:-1] > 0])
    change = np.concatenate([[0.0], change])
    finite = usable & np.isfinite(change)
    level = np.median(change[finite]) if finite.any() else 0.0
    clean = np.where(finite, change - level, 0.0).astype(np.longdouble)

    def running(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(x)])

    n, bad, s1, s2 = running(usable.astype(np.int64)), running((usable & ~finite).astype(np.int64)), running(clean), running(clean * clean)
    low = np.maximum(wanted - size + 1, 0)
    now, end = us[wanted], wanted + 1
    out = {"price": price[wanted], "bid": bid[wanted], "ask": ask[wanted]}
    with np.errstate(divide="ignore", invalid="ignore"):
        for name, seconds in windows.returns.items():
            at = np.searchsorted(us, now - seconds * _MICROS, "right") - 1
            past = price[np.maximum(at, 0)]
            out[name] = np.where((at >= low) & (past > 0), (price[wanted] - past) / past * 100, 0.0)
        for name, seconds in windows.volatility.items():
            # the oldest tick of the buffer has no predecessor in it
            start = np.maximum(np.searchsorted(us, now - seconds * _MICROS, "left"), low + 1)
            k, a, b = n[end] - n[start], s1[end] - s1[start], s2[end] - s2[start]
            variance = np.maximum((b - a * a / k) / (k - 1), 0)
            sigma = np.where(bad[end] - bad[start] > 0, np.nan, np.sqrt(variance.astype(np.float64)))
            out[name] = np.where(k >= 2, sigma, 0.0)
        out["spread"] = np.where((price[wanted] > 0) & (ask[wanted] >= bid[wanted]), (ask[wanted] - bid[wanted]) / price[wanted] * 100, 0.0)
        for name, seconds in windows.intensity.items():
            ticks = end - np.maximum(np.searchsorted(us, now - seconds * _MICROS, "left"), low)
            out[name] = np.where(ticks >= 2, ticks / seconds, 0.0)
    return out


class TickBuffer(StatefulProcessor):
    """Keeps the last ``buffer_size`` ticks of a symbol and emits a feature row per new time.

    A tick that is older than held ones takes its place among them: its row, and later ones, see what the buffer holds up to
    their time.  Rows already emitted stay.  With ``in_event_time`` ticks wait until the watermark has passed them, so arrival
    within the watermark's delay does not matter.  With ``tag_late`` a tick older than the newest one that its symbol has
    released is not taken in but returned, tagged.
    """

    def __init__(self, windows: FeatureWindows, in_event_time: bool = False, tag_late: bool = False):
        self.windows, self.in_event_time, self.tag_late = windows, in_event_time, tag_late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", _TICK)
        self.waiting = handle.getMapState("waiting", _BLOCK, "ticks binary") if self.in_event_time else None
        self.released = handle.getValueState("released", "us bigint") if self.tag_late else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # one symbol of one micro-batch
        if self.in_event_time:
            yield from self._take_in(key, rows)
            yield from self._release(key, timerValues)
        else:  # its size is bounded by the trigger's rate limit
            yield from self._emit(key, [self._columns(pd.concat(list(rows)))])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.in_event_time:
            yield from self._release(key, timerValues)

    @staticmethod
    def _columns(frame: pd.DataFrame) -> list[np.ndarray]:
        return [frame["ts"].astype("datetime64[us]").astype("int64").to_numpy(), frame["seq"].to_numpy("int64"),
                *(frame[c].to_numpy("float64") for c in ("price", "bid", "ask"))]

    @staticmethod
    def _held(state) -> list[np.ndarray]:
        rows = list(state.get()) if state.exists() else []
        return [np.array([r[i] for r in rows], dtype="int64" if i < 2 else "float64") for i in range(5)]

    @staticmethod
    def _put(state, columns: list[np.ndarray]) -> None:
        state.put(list(zip(*(c.tolist() for c in columns))))

    @staticmethod
    def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Ticks of several parts in (time, arrival) order."""
        columns = [np.concatenate(c) for c in zip(*parts)]
        order = np.lexsort((columns[1], columns[0]))
        return [c[order] for c in columns]

    def _blocks(self) -> list[tuple]:
        return sorted(tuple(k) for k in self.waiting.keys())

    def _put_block(self, columns: list[np.ndarray], run: int, place: int) -> None:
        block = (int(columns[0][0]), int(columns[1][0]), run, place, len(columns[0]))
        self.waiting.updateValue(block, (b"".join(c.tobytes() for c in columns),))

    def _taken_block(self, block: tuple) -> list[np.ndarray]:
        packed = bytes(self.waiting.getValue(block)[0])
        self.waiting.removeKey(block)
        n = len(packed) // _TICK_BYTES
        return [np.frombuffer(packed, "int64" if i < 2 else "float64", n, i * n * 8) for i in range(5)]

    def _put_run(self, columns: list[np.ndarray], run: int) -> None:
        for place, low in enumerate(range(0, len(columns[0]), _BLOCK_ROWS)):
            self._put_block([c[low:low + _BLOCK_ROWS] for c in columns], run, place)

    def _take_in(self, key, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Let the ticks of a micro-batch wait, a sorted run after the other; late ones are returned instead."""
        released = self.released.get()[0] if self.tag_late and self.released.exists() else None
        run = 1 + max((b[2] for b in self._blocks()), default=-1)
        parts, n = [], 0
        for frame in rows:
            new = self._columns(frame)
            if released is not None:
                late = new[0] < released
                if late.any():
                    yield self._tagged(key, [c[late] for c in new])
                new = [c[~late] for c in new]
            parts.append(new)
            n += len(new[0])
            if n >= _RUN_ROWS:
                self._put_run(self._joined(parts), run)
                parts, n, run = [], 0, run + 1
        if n:
            self._put_run(self._joined(parts), run)

    def _release(self, key, timerValues) -> Iterator[pd.DataFrame]:
        """Emit the waiting ticks that the watermark has passed; a timer wakes the rest."""
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        due = [b for b in self._blocks() if b[0] <= upto]
        if due:
            for frame in self._emit(key, self._passed(due, upto)):
                yield frame.assign(late=False) if self.tag_late else frame
        self._merge_small()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        rest = self._blocks()
        if rest:
            self.handle.registerTimer(rest[0][0] // 1000 + 1)

    def _passed(self, due: list[tuple], upto: int) -> Iterator[list[np.ndarray]]:
        """The ticks of ``due`` up to a time, in order and a piece at a time: what lies before the first tick of the next block is complete.

        ``due`` is in order of first ticks.  No more is in memory than a piece, and a block of each run that goes on behind it.
        """
        parts, n, enough = [], 0, _RUN_ROWS // 8
        for i, block in enumerate(due):
            columns = self._taken_block(block)
            cut = int(np.searchsorted(columns[0], upto, "right"))
            if cut < len(columns[0]):
                self._put_block([c[cut:] for c in columns], *block[2:4])
            parts.append([c[:cut] for c in columns])
            n += cut
            last = i + 1 == len(due)
            if last or n >= enough:
                ready = self._joined(parts)
                if not last:
                    us, seq = due[i + 1][:2]
                    before = np.searchsorted(ready[0], us, "left")
                    before += np.searchsorted(ready[1][before:np.searchsorted(ready[0], us, "right")], seq, "left")
                    parts = [[c[before:] for c in ready]]
                    n, ready = len(parts[0][0]), [c[:before] for c in ready]
                    enough = max(2 * n, _RUN_ROWS // 8)
                if self.tag_late and len(ready[0]):
                    self.released.update((int(ready[0][-1]),))
                if len(ready[0]):
                    yield ready

    def _merge_small(self) -> None:
        """Small micro-batches leave small blocks: many of them become one run."""
        blocks = self._blocks()
        small = [b for b in blocks if b[4] < _BLOCK_ROWS // 2]
        if len(small) >= _SMALL_BLOCKS:
            run = 1 + max(b[2] for b in blocks)
            self._put_run(self._joined([self._taken_block(b) for b in small]), run)

    @staticmethod
    def _tagged(key, ticks: list[np.ndarray]) -> pd.DataFrame:
        us, seq, price, bid, ask = ticks
        given = {"symbol": key[0], "seq": seq, "ts": us.astype("datetime64[us]"), "price": price, "bid": bid, "ask": ask}
        empty = {c: np.full(len(us), np.nan) for c in FEATURE_ROW.fieldNames() if c not in given}
        return pd.DataFrame(given | empty)[FEATURE_ROW.fieldNames()].assign(late=True)

    def _emit(self, key, pieces: Iterable[list[np.ndarray]]) -> Iterator[pd.DataFrame]:
        held, size = self._held(self.buffer), self.windows.buffer_size
        for new in pieces:
            full = len(held[0]) >= size  # older ticks have left
            fresh = np.concatenate([np.zeros(len(held[0]), bool), np.ones(len(new[0]), bool)])
            columns = [np.concatenate([a, b]) for a, b in zip(held, new)]
            order = np.lexsort((columns[1], columns[0]))
            us, seq, price, bid, ask = columns = [c[order] for c in columns]
            place = np.arange(len(us))
            first_of_time = np.concatenate([[False], us[1:] != us[:-1]])
            wanted = place[fresh[order] & (first_of_time | ((place == 1) & (not full)))]
            if len(wanted):
                out = {"symbol": key[0], "seq": seq[wanted], "ts": us[wanted].astype("datetime64[us]")}
                out |= features_at(us, price, bid, ask, wanted, self.windows)
                yield pd.DataFrame(out)[FEATURE_ROW.fieldNames()]
            held = [c[-size:].copy() for c in columns]
        self._put(self.buffer, held)

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that keyed list state needs; call it for sessions that run these streams."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stream_tick_features(
    ticks: DataFrame, windows: FeatureWindows = FeatureWindows(), watermark: str | None = None, tag_late: bool = False,
) -> DataFrame:
    """The streaming twin of ``operators.features.tick_features``.

    Ticks of a micro-batch are taken in (ts, seq) order.  Repeated times are not emitted but stay in the buffer, which is why
    this is not ``dropDuplicates``.  With ``watermark`` (such as "10 minutes") ticks are taken in time order across
    micro-batches: they wait until the watermark passes them, and ticks older than it are dropped.  With ``tag_late`` none is:
    the rows get a column ``late``, and a tick that is older than the newest one released for its symbol comes out as such a row,
    with its price and quote and no features (see ``jobs.split_late``).  One that is not older still takes its place.
    """
    if tag_late and not watermark:
        raise ValueError("ticks are late against a watermark: give one")
    if windows.buffer_size is None:
        raise ValueError("a stream keeps a bounded buffer: give a buffer_size")
    if ticks.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError("set the RocksDB state store first: streaming.features.use_rocksdb(spark)")
    typed = ticks.select("symbol", "seq", ticks["ts"].cast("timestamp").alias("ts"), "price", "bid", "ask")
    if watermark:
        typed = typed.withWatermark("ts", watermark)
    if tag_late:  # a computed time is no event-time column to Spark, which then leaves it to the processor what is late
        typed = typed.withColumn("ts", F.timestamp_micros(F.unix_micros("ts")))
    row = T.StructType([*FEATURE_ROW.fields, T.StructField("late", T.BooleanType())]) if tag_late else FEATURE_ROW
    return typed.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=TickBuffer(windows, bool(watermark), tag_late), outputStructType=row, outputMode="Append",
        timeMode="EventTime" if watermark else "None",
    )


def stamped(features: DataFrame) -> DataFrame:
    """Feature rows with ``computed_at``, the processing time of their micro-batch."""
    return features.withColumn("computed_at", F.current_timestamp())
