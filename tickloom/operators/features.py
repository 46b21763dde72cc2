"""Tick features over the last ``buffer_size`` ticks of a symbol, and labels over the ticks ahead.

Hot symbols.  The result for a tick depends on at most ``buffer_size`` ticks ending at it, so a symbol's timeline
may be cut anywhere as long as each chunk also gets that many ticks before it
(:mod:`tickloom.operators.ordered`).  One shuffle by (symbol, chunk), one sort.

Bursts.  Spark recomputes a sliding frame row by row, which costs (ticks in the window) per tick.  All frames here
start at UNBOUNDED PRECEDING instead, which Spark extends incrementally: a window's content is the
difference of two running totals, those at the tick and those at the last tick outside the window.  So that
differences lose nothing, every addend is first cut into limbs on a binary grid, and the limbs are summed as whole numbers
(:func:`_with_totals`).  Totals of chunks are carried over into the next limb before they are summed in turn, so totals of any
number of rows are exact.  What remains is the rounding of the formula itself: a deviation is resolved down to about 10^-8 of
the returns it is taken over.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.columns import above, percent_change, spread_percent
from tickloom.operators.ordered import OrderedSplit, split_ordered
from tickloom.schemas import FEATURES, FeatureWindows
from tickloom.session import written

_MICROS = 1_000_000
# limbs of 30 bits: a 64-bit sum holds those of 2^33 rows of one chunk; beyond that it fails loudly
_LIMB_BITS = 30
_LIMBS = 3
_MOMENTS = [f"_{m}{i}" for m in ("r", "q") for i in range(_LIMBS)]
_TOTALS = ["_n", "_bad", *_MOMENTS]
# what limbs carry over beyond the first, once chunks are added up
_TOPS = ["_rt", "_qt"]


def _split_ticks(ticks: DataFrame, chunk_rows: int | None, track_last: bool = False) -> tuple[DataFrame, OrderedSplit]:
    base = ticks.withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    return base, split_ordered(
        base.select("symbol", "_us", "seq"), ["symbol"], ["_us", "seq"], chunk_rows=chunk_rows, track_last=track_last
    )


def _ranked(ticks: DataFrame, rows_before: int | None, chunk_rows: int | None, seconds_before: int = 0) -> tuple[DataFrame, list[str]]:
    """Ticks by chunk with arrival number, previous tick, and tick return.

    Chunks get ``rows_before`` earlier ticks; if that is None, those of ``seconds_before`` and one more.
    """
    base, split = _split_ticks(ticks, chunk_rows, rows_before is None)
    copied = split.with_halo(base, span_before=seconds_before * _MICROS) if rows_before is None else split.with_halo(base, rows_before=rows_before)
    w = Window.partitionBy(*split.keys).orderBy("_us", "seq")
    ranked = split.gather(copied).withColumns({
        "_rn": F.row_number().over(w) + F.col("_base"),
        "_prev_price": F.lag("price").over(w),
        "_prev_us": F.lag("_us").over(w),
    })
    ret = F.when(above(F.col("_prev_price"), 0), percent_change(F.col("price"), F.col("_prev_price")))
    return ranked.withColumn("_ret", ret), split.keys


def _with_totals(ranked: DataFrame, keys: Sequence[str], largest: str | None = None) -> DataFrame:
    """Running totals of the tick returns up to each tick: number, non-finite ones, and limbs of r and r * r; ``_e`` is the grid.

    Each value is cut into limbs on ever finer binary grids (from the largest return of the chunk, or from the column named
    ``largest``, where it is known); the limbs are whole numbers that add up to the value.  One projection per limb keeps each of
    them small.
    """
    finite = F.col("_ret").isNotNull() & (F.abs("_ret") < F.lit(float("inf")))
    chunk = Window.partitionBy(*keys)
    running = chunk.orderBy("_us", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exponent = F.when(F.col("_max") > 0, F.ceil(F.log2("_max")) + 1).otherwise(F.lit(0)).cast("double")
    of_chunk = F.max(F.abs("_restr")).over(chunk)
    cut = (
        ranked.withColumn("_restr", F.when(finite, F.col("_ret")).otherwise(F.lit(0.0)))
        .withColumn("_max", F.coalesce(F.col(largest), of_chunk) if largest else of_chunk)
        .withColumns({
            "_e": exponent, "_restq": F.col("_restr") * F.col("_restr"),
            "_add_n": F.col("_ret").isNotNull().cast("int"),
            "_add_bad": (F.col("_ret").isNotNull() & ~finite).cast("int"),
        })
        .withColumns({f"_gridr{i}": F.pow(F.lit(2.0), F.col("_e") - _LIMB_BITS * (i + 1)) for i in range(_LIMBS)})
        .withColumns({f"_gridq{i}": F.pow(F.lit(2.0), F.col("_e") * 2 - _LIMB_BITS * (i + 1)) for i in range(_LIMBS)})
    )
    for i in range(_LIMBS):
        cut = cut.withColumns({f"_add_{m}{i}": F.rint(F.col(f"_rest{m}") / F.col(f"_grid{m}{i}")) for m in "rq"})
        cut = cut.withColumns({f"_rest{m}": F.col(f"_rest{m}") - F.col(f"_add_{m}{i}") * F.col(f"_grid{m}{i}") for m in "rq"})
    totals = (F.sum(F.col(f"_add{n}").cast("long")).over(running).alias(n) for n in _TOTALS)
    return cut.select(*ranked.columns, "_e", F.struct(F.col("_rn").alias("rn"), *totals).alias("_tot"))


def _carried_over(total: str) -> list[Column]:
    """The limbs of a total, each below 2^30 but for the tops: sums of such limbs over all chunks fit a long."""
    out = []
    for m, top in zip("rq", _TOPS):
        above = F.lit(0).cast("long")
        limbs = []
        for i in reversed(range(_LIMBS)):
            whole = F.col(f"{total}._{m}{i}") + above
            limbs.append(whole.bitwiseAND((1 << _LIMB_BITS) - 1).alias(f"_{m}{i}"))
            above = F.shiftright(whole, _LIMB_BITS)
        out += [above.alias(top), *reversed(limbs)]
    return out


def _joined(moment: str, limb) -> Column:
    """The double that the limbs of a difference of totals stand for; ``limb`` gives each by its name."""
    width = float(1 << _LIMB_BITS)
    value = reduce(lambda acc, i: acc * width + limb(f"_{moment}{i}"), range(_LIMBS), limb(_TOPS["rq".index(moment)]) * F.lit(1.0))
    return value * F.pow(F.lit(2.0), F.col("_e") * (2 if moment == "q" else 1) - _LIMB_BITS * _LIMBS)


def _until(keys: Sequence[str], what: Column, upper: int) -> Column:
    """``what`` (a struct led by the arrival number) of the last tick with time <= current time + ``upper`` us."""
    frame = Window.partitionBy(*keys).orderBy("_us").rangeBetween(Window.unboundedPreceding, upper)
    return F.max(what).over(frame)


def _sums_between(name: str, upto: str, outside: Column) -> tuple[dict, dict]:
    """Columns for two projections, one after the other: the running total ``outside`` the range, then number,
    non-finite ones, sum and sum of squares of the returns between it and ``upto``."""
    def between(part: str) -> Column:
        return F.lit(0) if part in _TOPS else F.col(f"{upto}.{part}") - F.coalesce(F.col(f"_from_{name}.{part}"), F.lit(0))

    return {f"_from_{name}": outside}, _moments(name, between)


def _moments(name: str, between) -> dict[str, Column]:
    return {f"_n_{name}": between("_n"), f"_bad_{name}": between("_bad"), f"_s1_{name}": _joined("r", between), f"_s2_{name}": _joined("q", between)}


def _deviation(name: str) -> Column:
    """Sample deviation from those sums; 0.0 below two returns."""
    n, bad, s1, s2 = (F.col(f"_{k}_{name}") for k in ("n", "bad", "s1", "s2"))
    variance = F.greatest((s2 - s1 * s1 / n) / (n - 1), F.lit(0.0))
    return F.when(n < 2, F.lit(0.0)).when(bad > 0, F.lit(float("nan"))).otherwise(F.sqrt(variance))


def _emits() -> Column:
    """The second tick always, later ticks when their time differs from the previous tick's."""
    return (F.col("_rn") == 2) | ((F.col("_rn") > 2) & (F.col("_us") != F.col("_prev_us")))


def _held_price(past: str, buffer_size: int | None) -> Column:
    """Price of an earlier tick if the buffer still holds it."""
    price = F.col(f"{past}.price")
    return price if buffer_size is None else F.when(F.col(f"{past}.rn") > F.col("_rn") - buffer_size, price)


def tick_features(
    ticks: DataFrame, windows: FeatureWindows = FeatureWindows(), chunk_rows: int | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """symbol, seq, ts and the 13 features for every tick that the live featurizer would emit.

    ``ticks``: symbol, seq (arrival order), ts, price, bid, ask.  ``columns`` limits the features computed.

    With a ``buffer_size`` of None every earlier tick counts: windows hold all of their ticks, and a past price may be of any
    age.  Chunks then get the ticks of the longest window before them and, for past prices, the last one that is older.
    """
    size = windows.buffer_size
    wanted = columns or FEATURES
    returns = {n: s for n, s in windows.returns.items() if n in wanted}
    volatility = {n: s for n, s in windows.volatility.items() if n in wanted}
    intensity = {n: s for n, s in windows.intensity.items() if n in wanted}
    spans = sorted({*volatility.values(), *intensity.values()})

    ranked, keys = _ranked(ticks, size, chunk_rows, max([0, *returns.values(), *spans]))
    priced = F.struct(F.col("_rn").alias("rn"), F.col("price").alias("price"))

    # The work is spread over projections between the window steps, each of which Spark compiles on its own: all in
    # one place the generated method outgrows what the JVM's compiler takes, and runs interpreted.
    ranked = ranked.withColumns({f"_past_{n}": _until(keys, priced, -s * _MICROS) for n, s in returns.items()})
    ready = {"spread": spread_percent(F.col("price"), F.col("bid"), F.col("ask"))} if "spread" in wanted else {}
    for n in returns:
        past = _held_price(f"_past_{n}", size)
        ready[n] = F.coalesce(F.when(above(past, 0), percent_change(F.col("price"), past)), F.lit(0.0))
    ranked = ranked.withColumns(ready).drop(*(f"_past_{n}" for n in returns))

    if volatility:
        ranked = _with_totals(ranked, keys)
        if size is not None:
            arrival = Window.partitionBy(*keys).orderBy("_us", "seq")
            ranked = ranked.withColumn("_full", F.lag("_tot", size - 1).over(arrival))
    position = F.col("_tot") if volatility else F.struct(F.col("_rn").alias("rn"))
    ranked = ranked.withColumns({f"_out{s}": _until(keys, position, -s * _MICROS - 1) for s in spans})

    # ticks inside the window, the current one included; anything from ``size`` up means a full buffer
    counts = {f"_c{s}": F.col("_rn") - F.coalesce(F.col(f"_out{s}.rn"), F.col("_base")) for s in spans}
    emitted = ranked.where(F.col("_own") & _emits()).withColumns(counts)
    outside, sums = {}, {}
    for n, s in volatility.items():
        out_of = F.col(f"_out{s}") if size is None else F.when(F.col(f"_c{s}") >= size, F.col("_full")).otherwise(F.col(f"_out{s}"))
        first, then = _sums_between(n, "_tot", out_of)
        outside, sums = outside | first, sums | then
    kept = ["symbol", "seq", "ts", "price", "bid", "ask", *ready, *counts]
    reduced = emitted.withColumns(outside).select(*kept, *(c.alias(k) for k, c in sums.items()))

    out: dict[str, Column] = {c: F.col(c) for c in ("price", "bid", "ask", *ready)}
    out |= {n: _deviation(n) for n in volatility}
    for n, s in intensity.items():
        held = F.col(f"_c{s}") if size is None else F.least(F.col(f"_c{s}"), F.lit(size))
        out[n] = F.when(held >= 2, held / F.lit(float(s))).otherwise(F.lit(0.0))
    return reduced.select("symbol", "seq", "ts", *(out[c].alias(c) for c in FEATURES if c in wanted))


def asof_past_price(
    ticks: DataFrame, seconds: int, buffer_size: int | None = 500, chunk_rows: int | None = None
) -> DataFrame:
    """Per emitted tick the most recent price at least ``seconds`` old (NULL if the buffer, or without one the symbol, has none)."""
    ranked, keys = _ranked(ticks, buffer_size, chunk_rows, seconds)
    priced = F.struct(F.col("_rn").alias("rn"), F.col("price").alias("price"))
    return (
        ranked.withColumn("_past", _until(keys, priced, -seconds * _MICROS)).where(F.col("_own") & _emits())
        .select("symbol", "seq", "ts", "price", _held_price("_past", buffer_size).alias("past_price"))
    )


def tick_returns(ticks: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Percent change against the previous tick of the symbol; NULL for the first tick or a price <= 0 before it."""
    return _ranked(ticks, 1, chunk_rows)[0].where("_own").select(
        "symbol", "seq", "ts", "price", F.col("_rn").alias("rn"), F.col("_ret").alias("tick_return")
    )


def emitted_ticks(ticks: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Ticks that yield a feature row: not the first of a symbol, and not a repeat of the previous time."""
    return _ranked(ticks, 1, chunk_rows)[0].where(F.col("_own") & _emits()).select(
        *ticks.columns, F.col("_rn").alias("rn")
    )


def with_history(ticks: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Ticks with at least one earlier tick of their symbol."""
    return _ranked(ticks, 1, chunk_rows)[0].where(F.col("_own") & (F.col("_rn") >= 2)).select(
        *ticks.columns, F.col("_rn").alias("rn")
    )


def _chunk_at(split: OrderedSplit, rows: DataFrame, us: Column) -> DataFrame:
    """Rows with ``_probe_chunk``: the last chunk of the symbol that begins at or before ``us``.

    The begins of the chunks, at most MAX_CHUNKS in all, are searched by halving.
    """
    begins = []
    for group, slices in split.groups.items():
        first: dict[int, int] = {}
        for s in slices:
            if s.low[0] is not None:
                first.setdefault(s.chunk, s.low[0])
        begins.append((*group, [first.get(c, -(1 << 62)) for c in range(slices[-1].chunk + 1)]))
    kind = rows.schema["symbol"].dataType.simpleString()
    table = rows.sparkSession.createDataFrame(begins, f"_b_symbol {kind}, _begins array<bigint>")
    joined = rows.join(F.broadcast(table), F.col("symbol").eqNullSafe(F.col("_b_symbol")), "left")
    steps = [1 << i for i in reversed(range(max(len(x[-1]) for x in begins).bit_length()))]

    def step(at: Column, by: Column) -> Column:
        fits = (at + by < F.size("_begins")) & (F.get("_begins", F.least(at + by, F.size("_begins") - 1)) <= us)
        return F.when(fits, at + by).otherwise(at)

    found = F.aggregate(F.array(*(F.lit(x) for x in steps)), F.lit(0), step)
    return joined.withColumn("_probe_chunk", F.when(F.col("_begins").isNull(), 0).otherwise(found)).drop("_b_symbol", "_begins")


def _ahead(ticks: DataFrame, horizon: float, chunk_rows: int | None, totals: bool) -> DataFrame:
    """One row per (symbol, time): its last tick with ``_tot`` (running totals of the symbol, else the price) there, and ``_end``,
    the same of the last tick up to t + horizon.

    The look ahead is a probe row that goes to the chunk in which t + horizon falls: two rows per tick, however many ticks
    the horizon holds.  Ticks without a time have no window and give no row.
    """
    horizon_us = int(horizon * _MICROS)
    base, split = _split_ticks(ticks.where(F.col("ts").isNotNull()), chunk_rows)
    w = Window.partitionBy(*split.keys).orderBy("_us", "seq")
    ranked = split.gather(split.with_halo(base, rows_before=1, rows_after=1)).withColumns({
        "_rn": F.row_number().over(w) + F.col("_base"), "_prev_price": F.lag("price").over(w),
        "_next_us": F.lead("_us").over(w), "_next_price": F.lead("price").over(w),
    })
    own = ranked.withColumn(
        "_ret", F.when(above(F.col("_prev_price"), 0), percent_change(F.col("price"), F.col("_prev_price")))).where("_own")
    wide = ["symbol", "_chunk", "ts", "_us", "seq", "price", "_rn", "_next_us", "_next_price"]
    if totals:
        known = _running_totals(own.select(*wide, "_ret"), split).select(*wide, "_e", "_tot")
    else:
        known = own.select(*wide, F.lit(0.0).alias("_e"), F.struct(F.col("_rn").alias("rn"), F.col("price").alias("price")).alias("_tot"))
        known = written(known, "ahead")

    last_of_time = F.col("_next_us").isNull() | (F.col("_next_us") != F.col("_us"))
    target = F.col("_us") + horizon_us
    origin = F.struct("ts", "_us", "price", "_rn", "_next_us", "_next_price", "_e", "_tot")
    probes = known.where(last_of_time).withColumn("_target", target)
    probes = _chunk_at(split, probes, F.col("_target")) if split.is_cut else probes.withColumn("_probe_chunk", F.lit(0))
    probes = probes.select("symbol", F.col("_probe_chunk").alias("_chunk"), F.col("_target").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).alias("_here"), origin.alias("_origin"))
    held = known.select("symbol", "_chunk", F.col("_us").alias("_at"), F.lit(0).alias("_kind"), F.col("_tot").alias("_here"), F.lit(None).alias("_origin"))
    upto = Window.partitionBy("symbol", "_chunk").orderBy("_at", "_kind", "_here.rn").rowsBetween(Window.unboundedPreceding, 0)
    seen = held.unionByName(probes).withColumn("_end", F.last("_here", ignorenulls=True).over(upto)).where("_kind = 1")
    return seen.select("symbol", "_end", "_origin.*").withColumn("_coming", F.col("_next_us") <= target)


def _running_totals(own: DataFrame, split: OrderedSplit) -> DataFrame:
    """``own`` (each tick once, by chunk) with ``_tot`` over the whole symbol: a scan inside the chunks, then one over their totals.

    Chunk totals are rows of the symbols that were cut, at most MAX_CHUNKS in all, and so are the tables that are broadcast.
    """
    nothing = F.lit(0).cast("long")
    if not split.is_cut:
        known = _with_totals(own, split.keys)
        return written(known.withColumn("_tot", F.struct("_tot.*", *(nothing.alias(t) for t in _TOPS))), "ahead")
    symbol = own.schema["symbol"].dataType.simpleString()
    cut = F.broadcast(own.sparkSession.createDataFrame([g for g in split.groups], f"_cut_symbol {symbol}"))
    own = written(own, "ahead-returns")
    of_cut = F.col("symbol").eqNullSafe(F.col("_cut_symbol"))
    finite = F.when(F.abs("_ret") < F.lit(float("inf")), F.abs("_ret"))
    # all chunks of a symbol share one grid
    largest = own.join(cut, of_cut).groupBy("_cut_symbol").agg(F.coalesce(F.max(finite), F.lit(0.0)).alias("_largest"))
    gridded = own.join(F.broadcast(largest), of_cut, "left").drop("_cut_symbol")
    known = written(_with_totals(gridded, split.keys, "_largest").drop("_largest"), "ahead")

    ends = known.join(cut, of_cut).groupBy("_cut_symbol", "_chunk").agg(F.max_by("_tot", "_rn").alias("_all"))
    plain = [F.col(f"_all.{n}").alias(n) for n in ("_n", "_bad")]
    ends = ends.select("_cut_symbol", F.col("_chunk").alias("_cut_chunk"), *plain, *_carried_over("_all"))
    earlier = Window.partitionBy("_cut_symbol").orderBy("_cut_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select("_cut_symbol", "_cut_chunk", F.struct(*(F.coalesce(F.sum(n).over(earlier), nothing).alias(n) for n in [*_TOTALS, *_TOPS])).alias("_before"))
    before = written(before, "ahead-before")
    moved = known.join(F.broadcast(before), of_cut & (F.col("_chunk") == F.col("_cut_chunk")), "left")
    added = [(F.col(f"_tot.{n}") + F.coalesce(F.col(f"_before.{n}"), nothing)).alias(n) for n in _TOTALS]
    tops = [F.coalesce(F.col(f"_before.{n}"), nothing).alias(n) for n in _TOPS]
    return moved.withColumn("_tot", F.struct(F.col("_tot.rn").alias("rn"), *added, *tops))


def future_window(ticks: DataFrame, horizon: float, chunk_rows: int | None = None) -> DataFrame:
    """Per (symbol, time): number of ticks in (t, t + horizon], and the first and last price among them."""
    return _ahead(ticks, horizon, chunk_rows, totals=False).select(
        "symbol", "ts", (F.col("_end.rn") - F.col("_rn")).alias("future_ticks"),
        F.when(F.col("_coming"), F.col("_next_price")).alias("future_first"),
        F.when(F.col("_coming"), F.col("_end.price")).alias("future_last"),
    )


def _sums_ahead(name: str, minus: Column) -> dict[str, Column]:
    """Number, non-finite ones, sum and sum of squares of the returns after the tick up to the probe, without ``minus``."""
    sums = _moments(name, lambda part: F.col(f"_end.{part}") - F.col(f"_tot.{part}"))
    less = {f"_n_{name}": minus.isNotNull().cast("int"), f"_s1_{name}": F.coalesce(minus, F.lit(0.0)), f"_s2_{name}": F.coalesce(minus * minus, F.lit(0.0))}
    return {k: c - less[k] if k in less else c for k, c in sums.items()}


def future_volatility(
    ticks: DataFrame, horizon: float, threshold: float, chunk_rows: int | None = None
) -> DataFrame:
    """Sample deviation (percent) of the tick returns inside (t, t + horizon], and the label sigma >= threshold.

    One row per (symbol, time).  The first future tick has no return inside the window; fewer than two returns
    give 0.0.  ``complete`` is false where the data ends before t + horizon.
    """
    last_us = ticks.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).scalar()
    leading = F.when(above(F.col("price"), 0), percent_change(F.col("_next_price"), F.col("price")))
    sums = _sums_ahead("sigma", F.col("_leading"))
    return (
        _ahead(ticks, horizon, chunk_rows, totals=True).withColumn("_leading", leading)
        .select("symbol", "ts", "_us", "_coming", *(c.alias(k) for k, c in sums.items()))
        .withColumn("future_volatility", F.when(
            F.coalesce("_coming", F.lit(False)), _deviation("sigma")).otherwise(F.lit(0.0)))
        .select(
            "symbol", "ts", "future_volatility",
            ((F.col("future_volatility") >= threshold) & ~F.isnan("future_volatility")).cast("int").alias("future_spike"),
            (F.col("_us") + int(horizon * _MICROS) <= last_us).alias("complete"),
        )
    )
