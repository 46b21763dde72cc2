"""Profiles of numeric columns: moments, quantiles, missing and extreme values, correlation, timing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickloom.functions.columns import missing, per
from tickloom.operators.ordered import cumulative, exact_quantiles, split_ordered
from tickloom.session import written

_MICROS = 1e6


def per_column(df: DataFrame, columns: Sequence[str], measures: dict[str, Callable[[str], Column]],
               by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and key): ``feature`` and the aggregates.  One pass, combined before any shuffle."""
    by = list(by)
    wide = df.groupBy(*by).agg(*(e(c).alias(f"{m}__{i}") for i, c in enumerate(columns) for m, e in measures.items()))
    rows = F.array(*(
        F.struct(F.lit(c).alias("feature"), *(F.col(f"{m}__{i}").alias(m) for m in measures))
        for i, c in enumerate(columns)
    ))
    return wide.select(*by, F.inline(rows))


def unpivoted(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``feature, value`` rows; NaN becomes NULL, integers become doubles."""
    values = F.array(*(
        F.struct(F.lit(c).alias("feature"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value"))
        for c in columns
    ))
    return df.select(*by, F.inline(values))


def _known(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None))


#: Rank error of the sketch that brackets a quantile (1 / accuracy), the bracket's half-width, and rows up to which all are taken.
_ACCURACY, _HALF, _FEW = 10_000, 3e-4, 20_000


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation: ``feature, n`` and a column per name in ``probs``; one row per column.

    The rows stay wide.  One pass brackets every quantile by mergeable sketches, one counts the values below each bracket, and
    one fetches the few values inside; only those are ordered.  (With ``by`` the values are ordered by counting instead.)
    """
    if by:
        return exact_quantiles(unpivoted(df, columns, by), [*by, "feature"], "value", probs)
    points = sorted({0.0, 1.0, *(max(0.0, q - _HALF) for q in probs.values()), *(min(1.0, q + _HALF) for q in probs.values())})
    sketch = df.agg(*(x for i, c in enumerate(columns) for x in (
        F.percentile_approx(_known(c), points, _ACCURACY).alias(f"p{i}"), F.count(_known(c)).alias(f"n{i}")))).first()
    brackets = []  # (column, name, quantile, rows, low, high)
    for i, c in enumerate(columns):
        n, at = sketch[f"n{i}"], dict(zip(points, sketch[f"p{i}"] or [])) if sketch[f"n{i}"] else {}
        for name, q in probs.items() if n else ():
            ends = (0.0, 1.0) if n <= _FEW else (max(0.0, q - _HALF), min(1.0, q + _HALF))
            brackets.append((c, name, q, n, at[ends[0]], at[ends[1]]))
    schema = "feature string, _name string, _q double, n long, _low double, _high double"
    if not brackets:
        return df.sparkSession.createDataFrame([], "feature string, n long, " + ", ".join(f"{p} double" for p in probs))

    below = df.agg(*(F.sum((_known(c) < F.lit(low)).cast("long")).alias(f"b{i}") for i, (c, _, _, _, low, _) in enumerate(brackets))).first()
    inside = F.array(*(
        F.when(_known(c).between(F.lit(low), F.lit(high)), F.struct(F.lit(i).alias("_bracket"), _known(c).alias("value")))
        for i, (c, _, _, _, low, high) in enumerate(brackets)
    ))
    found = df.select(F.explode(F.array_compact(inside)).alias("_x")).groupBy("_x._bracket", "_x.value").agg(F.count("*").alias("times"))
    cum = cumulative(written(found, "quantiles"), ["_bracket"], "value", {"times": F.col("times")})

    table = df.sparkSession.createDataFrame([(i, *b, below[f"b{i}"]) for i, b in enumerate(brackets)], f"_bracket int, {schema}, _below long")  # a row per quantile
    upto = F.col("_below") + F.col("cum_times")
    rank = (F.col("n") - 1) * F.col("_q")

    def value_at(r: Column) -> Column:
        return F.max(F.when((upto - F.col("times") <= r) & (r < upto), F.col("value")))

    picked = cum.join(F.broadcast(table), "_bracket").groupBy("feature", "n", "_name", "_q").agg(
        value_at(F.floor(rank)).alias("_lo"), value_at(F.ceil(rank)).alias("_hi"))
    exact = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (rank - F.floor(rank))
    return picked.groupBy("feature", "n").agg(*(F.max(F.when(F.col("_name") == name, exact)).alias(name) for name in probs))


def describe_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    moments = per_column(df, columns, {
        "count": lambda c: F.count(_known(c)), "mean": lambda c: F.avg(_known(c)),
        "std": lambda c: F.stddev_samp(_known(c)), "min": lambda c: F.min(_known(c)),
        "max": lambda c: F.max(_known(c)),
    })
    quantiles = column_quantiles(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("n")
    # one row per column of the table
    return moments.join(F.broadcast(quantiles), "feature", "left")


def extended_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median, std, range, bias-corrected skewness and kurtosis, and missing values per column."""
    moments = per_column(df, columns, {
        "rows": lambda c: F.count(F.lit(1)), "n": lambda c: F.count(_known(c)).cast("double"),
        "mean": lambda c: F.avg(_known(c)), "std": lambda c: F.stddev_samp(_known(c)),
        "min": lambda c: F.min(_known(c)), "max": lambda c: F.max(_known(c)),
        "g1": lambda c: F.skewness(_known(c)), "g2": lambda c: F.kurtosis(_known(c)),
    })
    n = F.col("n")
    median = column_quantiles(df, columns, {"median": 0.5}).drop("n")
    return moments.join(F.broadcast(median), "feature", "left").select(
        "feature", "mean", "median", "std", "min", "max",
        F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.col("g1")).alias("skewness"),
        F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)).alias("kurtosis"),
        (F.col("rows") - n).cast("long").alias("missing"),
        (per(F.col("rows") - n, F.col("rows")) * 100).alias("missing_pct"),
    )


def _shares(df: DataFrame, columns: Sequence[str], name: str, flag: Callable[[str], Column],
            by: Sequence[str] = ()) -> DataFrame:
    counted = per_column(df, columns, {
        name: lambda c: F.sum(flag(c).cast("long")), "rows": lambda c: F.count(F.lit(1)),
    }, by)
    return counted.select(*by, "feature", F.coalesce(name, F.lit(0)).alias(name),
                          (per(F.col(name), F.col("rows")) * 100).alias(f"{name}_pct"))


def missing_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _shares(df, columns, "missing", missing, by).orderBy(F.desc("missing"), "feature")


def infinite_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _shares(
        df, columns, "infinite", lambda c: F.coalesce(F.abs(F.col(c).cast("double")) == float("inf"), F.lit(False))
    )


def _digest(df: DataFrame) -> list[Column]:
    """128 bits of a row: NULLs by their place, zeros without sign."""
    values = [F.col(c) + F.lit(0.0) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    absent = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in df.columns))
    return [F.xxhash64(absent, *values).alias("_d1"), F.xxhash64(F.lit("second"), absent, *values).alias("_d2")]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of identical rows, and their percentage; exact.

    Digests of 16 bytes are counted for all rows; only rows whose digest another row shares are compared in full.  Those digests
    are a written table of known size, so a small one is broadcast and filters the rows where they are.
    """
    digests = df.select(*_digest(df)).groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_copies"))
    digests = written(digests.groupBy((F.col("_copies") > 1).alias("_shared"), F.when(F.col("_copies") > 1, F.struct("_d1", "_d2")).alias("_d")).agg(
        F.sum("_copies").alias("_rows")), "digests")
    rows = digests.agg(F.coalesce(F.sum("_rows"), F.lit(0))).scalar()
    shared = digests.where("_shared").select("_d.*")
    suspects = df.withColumns(dict(zip(["_d1", "_d2"], _digest(df)))).join(shared, ["_d1", "_d2"], "left_semi")
    duplicates = F.coalesce(F.sum(F.col("count") - 1), F.lit(0))
    return suspects.groupBy(*df.columns).count().agg(duplicates.alias("duplicates")).select(
        F.when(rows > 0, rows).alias("rows"), F.when(rows > 0, F.col("duplicates")).alias("duplicates"),
        (F.col("duplicates") / F.when(rows > 0, rows) * 100).alias("duplicate_pct"))


#: log2 of the registers of a distinct-count sketch; its relative error has a deviation of 1.04 / sqrt(2 ^ this), here 1.6 %.
SKETCH_SIZE = 12


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """``feature, sketch, known`` per key of ``by`` (such as a day): sketches to be stored and merged later.  One pass."""
    # the sketch takes whole numbers: a hash of the value, a zero without sign, NaN left out
    return per_column(df, columns, {
        "sketch": lambda c: F.hll_sketch_agg(F.when(_known(c).isNotNull(), F.xxhash64(_known(c) + F.lit(0.0))), size), "known": lambda c: F.count(_known(c)),
    }, by)


def merged_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``feature, sketch, known, distinct_values`` of stored sketches, merged over all keys but ``by``."""
    merged = sketches.groupBy(*by, "feature").agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("known").alias("known"))
    return merged.withColumn("distinct_values", F.hll_sketch_estimate("sketch"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct, non-zero and missing values, range, mean and std per column.

    Exact distinct counts shuffle every distinct value once per task; ``approximate`` ones come from sketches of bounded size.
    """
    if approximate:
        distinct = merged_distinct(distinct_sketches(df, columns)).select("feature", "distinct_values")
    else:
        distinct = (
            unpivoted(df, columns).where(F.col("value").isNotNull()).groupBy("feature", "value").count()
            .groupBy("feature").agg(F.count(F.lit(1)).alias("distinct_values"))
        )
    rest = per_column(df, columns, {
        "non_zero": lambda c: F.sum((F.col(c) != 0).cast("long")), "min": lambda c: F.min(_known(c)),
        "max": lambda c: F.max(_known(c)), "mean": lambda c: F.avg(_known(c)),
        "std": lambda c: F.stddev_samp(_known(c)),
    })
    return rest.join(F.broadcast(distinct), "feature", "left")


def timestamp_uniqueness(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Distinct times, duplicate rate, and the sizes of groups with one time (mode: smallest on ties)."""
    sizes = (
        df.groupBy(ts).agg(F.count(F.lit(1)).alias("size"))
        .groupBy("size").agg(F.count(F.lit(1)).alias("groups"))
    )
    rows, unique = F.sum(F.col("size") * F.col("groups")), F.sum("groups")
    repeated = F.sum(F.when(F.col("size") > 1, F.col("groups")).otherwise(0))
    return sizes.agg(
        rows.alias("rows"), unique.alias("unique_times"), ((1 - unique / rows) * 100).alias("duplicate_pct"),
        F.max_by("size", F.struct("groups", -F.col("size"))).alias("usual_size"), F.max("size").alias("largest_size"),
        repeated.alias("repeated_times"), (repeated / unique * 100).alias("repeated_pct"),
    )


def time_differences(df: DataFrame, ts: str, tiebreak: str, by: Sequence[str] = (), chunk_rows=None) -> DataFrame:
    """Rows with ``rn`` (from 1) and ``time_diff``, seconds since the previous row of the key."""
    base = df.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    split = split_ordered(base.select(*by, "_us", tiebreak), by, ["_us", tiebreak], chunk_rows=chunk_rows)
    w = Window.partitionBy(*split.keys).orderBy("_us", tiebreak)
    return (
        split.with_halo(base, rows_before=1)
        .withColumns({
            "rn": F.row_number().over(w) + F.col("_base"),
            "time_diff": (F.col("_us") - F.lag("_us").over(w)) / _MICROS,
        })
        .where("_own").drop("_us", "_chunk", "_base", "_own")
    )


def gap_stats(df: DataFrame, ts: str, tiebreak: str, long_gap: float = 60.0,
              windows: Sequence[int] = (10, 30, 60)) -> DataFrame:
    """Mean, median, range and std of the time between rows, sampling rate, expected rows per window, long gaps."""
    gaps = time_differences(df.select(ts, tiebreak), ts, tiebreak).where(F.col("time_diff").isNotNull())
    gaps = written(gaps.select("time_diff"), "gaps")  # ranked and averaged: several passes over one ordered result
    median = exact_quantiles(gaps, [], "time_diff", {"median_gap": 0.5}).select("median_gap").scalar()
    out = gaps.agg(
        F.avg("time_diff").alias("mean_gap"), F.min("time_diff").alias("min_gap"), F.max("time_diff").alias("max_gap"),
        F.stddev_samp("time_diff").alias("std_gap"),
        F.sum((F.col("time_diff") > long_gap).cast("long")).alias("long_gaps"),
    ).withColumn("median_gap", median)
    out = out.withColumn(
        "rows_per_second", F.when(F.col("median_gap") > 0, 1 / F.col("median_gap")).otherwise(F.lit(0.0))
    )
    return out.withColumns({f"expected_{w}s": F.col("rows_per_second") * w for w in windows})


def continuous_period(df: DataFrame, ts: str, tiebreak: str, period: float = 60.0, max_gap: float = 10.0) -> DataFrame:
    """Whether a row is at least ``period`` before the last row and less than ``max_gap`` before the next one; the
    first such 0-based position (-1 if none)."""
    last = df.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp")))).scalar()
    steps = time_differences(df.select(ts, tiebreak), ts, tiebreak)
    start_us = F.unix_micros(F.col(ts).cast("timestamp")) - F.round(F.col("time_diff") * _MICROS).cast("long")
    good = (F.col("time_diff") < max_gap) & ((last - start_us) / _MICROS >= period)
    first = F.min(F.when(good, F.col("rn") - 2))
    return steps.agg(
        F.when(first.isNotNull(), 1).otherwise(0).alias("continuous_periods"),
        F.coalesce(first, F.lit(-1)).alias("first_index"),
    )


def percentile_curve(df: DataFrame, columns: Sequence[str],
                     percentiles: Sequence[int] = (10, 25, 50, 75, 90, 95, 99)) -> DataFrame:
    names = {f"p{p}": p / 100 for p in percentiles}
    return column_quantiles(df, columns, names).drop("n")


def threshold_analysis(df: DataFrame, column: str, percentiles: Sequence[int] = (90, 95, 99)) -> DataFrame:
    """Per percentile: threshold, rows above it, and their share in percent.  NULL and NaN count as missing."""
    known = df.select(_known(column).alias("value")).where(F.col("value").isNotNull())
    curve = exact_quantiles(known, [], "value", {f"p{p}": p / 100 for p in percentiles})
    limits = {p: curve.select(f"p{p}").scalar() for p in percentiles}
    wide = known.agg(
        F.count("value").alias("n"),
        *(F.sum((F.col("value") > v).cast("long")).alias(f"above_{p}") for p, v in limits.items()),
        *(F.max(v).alias(f"limit_{p}") for p, v in limits.items()),
    )
    return wide.select(F.inline(F.array(*(
        F.struct(F.lit(p).alias("percentile"), F.col(f"limit_{p}").alias("threshold"),
                 F.col(f"above_{p}").alias("spikes"), (per(F.col(f"above_{p}"), F.col("n")) * 100).alias("spike_rate"))
        for p in percentiles
    ))))


def _outside(df: DataFrame, columns: Sequence[str], bounds: DataFrame, outside: Callable[[Column, Column], Column]) -> DataFrame:
    """``bounds`` (one row per feature, with ``n``) and the number of values for which ``outside(value, bound)`` holds.

    The bounds are one scalar; the rows are read once, as they are, and counted in their tasks.
    """
    of = bounds.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("*"))))).scalar()  # one entry per column
    counts = per_column(df, columns, {"outliers": lambda c: F.sum(outside(_known(c), of[c]).cast("long"))})
    found = bounds.join(F.broadcast(counts.where(F.col("outliers") > 0)), "feature")
    return found.withColumn("outlier_pct", F.col("outliers") / F.col("n") * 100)


def iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Values beyond the quartiles by ``factor`` interquartile ranges; only columns that have some."""
    quartiles = column_quantiles(df, columns, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    bounds = quartiles.select(
        "feature", "n", (F.col("q1") - factor * iqr).alias("lower_bound"),
        (F.col("q3") + factor * iqr).alias("upper_bound"),
    )
    found = _outside(df, columns, bounds, lambda v, b: (v < b["lower_bound"]) | (v > b["upper_bound"]))
    return found.select("feature", "outliers", "outlier_pct", "lower_bound", "upper_bound").orderBy(F.desc("outliers"), "feature")


def zscore_outliers(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Values more than ``limit`` population deviations from the mean; only columns that have some."""
    moments = per_column(df, columns, {
        "n": lambda c: F.count(_known(c)), "mean": lambda c: F.avg(_known(c)),
        "sd": lambda c: F.stddev_pop(_known(c)),
    })
    found = _outside(df, columns, moments.where(F.col("sd") > 0), lambda v, b: per(F.abs(v - b["mean"]), b["sd"]) > limit)
    return found.select("feature", "outliers", "outlier_pct").orderBy(F.desc("outliers"), "feature")


#: Rows of one matrix product, and keys whose sums a worker holds.
_GRAM_ROWS, _GRAM_KEYS = 1 << 16, 256
#: A second moment below this share of what it was subtracted from is rounding.
_NOISE = 1e-14
_MOMENT_NAMES = ["n", "mean_a", "mean_b", "m2_a", "m2_b", "c", "bad"]


class _Gram:
    """Pairwise moments of some columns over the rows where both are known, as matrices; blocks of rows are merged exactly in step.

    Entry (a, b): number of rows, mean and second moment of a, co-moment of a and b, infinite values.
    """

    def __init__(self, columns: int):
        self.n, self.mean, self.m2, self.c, self.bad = (np.zeros((columns, columns)) for _ in range(5))

    def add(self, x: np.ndarray) -> None:
        """Rows of values, NaN where unknown.  They are shifted by the block's first known values, so large levels do not cancel."""
        known = ~np.isnan(x)
        infinite = np.isinf(x)
        there = known.astype(np.float64)
        at = np.where(known & ~infinite, x, np.nan)
        first = np.array([c[~np.isnan(c)][0] if (~np.isnan(c)).any() else 0.0 for c in at.T])
        shifted = np.where(known & ~infinite, x - first, 0.0)
        n = there.T @ there
        s, ss, q = shifted.T @ there, (shifted * shifted).T @ there, shifted.T @ shifted
        some = np.maximum(n, 1)
        mean = s / some
        m2 = ss - s * mean
        m2[m2 <= _NOISE * ss] = 0.0
        self._merge(n, mean + first[:, None] * (n > 0), m2, q - s * mean.T)
        self.bad += infinite.astype(np.float64).T @ there

    def _merge(self, n, mean, m2, c) -> None:
        whole = self.n + n
        weight = self.n * n / np.maximum(whole, 1)
        apart = np.where((self.n > 0) & (n > 0), mean - self.mean, 0.0)
        self.m2 += m2 + apart * apart * weight
        self.c += c + apart * apart.T * weight
        self.mean = np.where(self.n > 0, self.mean + apart * n / np.maximum(whole, 1), mean)
        self.n = whole

    def rows(self) -> dict[str, np.ndarray]:
        """Entries of the pairs a < b with rows."""
        a, b = np.triu_indices(len(self.n), 1)
        seen = self.n[a, b] > 0
        a, b = a[seen], b[seen]
        return {
            "a": a, "b": b, "n": self.n[a, b], "mean_a": self.mean[a, b], "mean_b": self.mean[b, a], "m2_a": self.m2[a, b], "m2_b": self.m2[b, a],
            "c": self.c[a, b], "bad": self.bad[a, b] + self.bad[b, a]}


def correlation_matrix(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation per column pair (upper triangle, NaN where a column is constant or holds an infinite value).

    One scan for any number of columns and pairs: each worker multiplies blocks of its rows (values and presence) into matrices
    of moments and returns one row per pair; those are merged about the common means.
    """
    by, names = list(by), list(columns)
    source = df.select(*by, *(_known(c).alias(f"_c{i}") for i, c in enumerate(names)))
    wide = [f"_c{i}" for i in range(len(names))]
    keys = T.StructType([source.schema[c] for c in by])
    schema = T.StructType([*keys, T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in _MOMENT_NAMES)])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Gram] = {}

        def taken() -> Iterator[pa.RecordBatch]:
            for key, gram in held.items():
                rows = gram.rows()
                size = len(rows["a"])
                arrays = [pa.array([v] * size, type=t) for v, t in zip(key, types)] + [pa.array(v) for v in rows.values()]
                yield pa.RecordBatch.from_arrays(arrays, names=[*by, *rows])
            held.clear()

        types: list = []
        for batch in batches:
            types = [batch.schema.field(c).type for c in by]
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in wide]) if wide else np.zeros((batch.num_rows, 0))
            groups = {(): np.arange(batch.num_rows)}
            if by:
                order = pa.Table.from_batches([batch.select(by)]).append_column("_row", pa.array(np.arange(batch.num_rows))).group_by(by, use_threads=False).aggregate([("_row", "list")])
                groups = {tuple(r[c] for c in by): np.array(r["_row_list"]) for r in order.to_pylist()}
            for key, rows in groups.items():
                gram = held.setdefault(key, _Gram(len(wide)))
                for low in range(0, len(rows), _GRAM_ROWS):
                    gram.add(x[rows[low:low + _GRAM_ROWS]])
            if len(held) > _GRAM_KEYS:
                yield from taken()
        yield from taken()

    parts = written(source.mapInArrow(moments, schema), "gram")  # a row per pair, key and task
    pair = [*by, "a", "b"]
    means = parts.groupBy(*pair).agg(*((F.sum(F.col("n") * F.col(m)) / F.sum("n")).alias(f"_{m}") for m in ("mean_a", "mean_b")))
    same = reduce(lambda x, y: x & y, [F.col(f"p.{c}").eqNullSafe(F.col(f"m.{c}")) for c in pair])
    both = parts.alias("p").join(means.alias("m"), same).select(*(F.col(f"p.{c}").alias(c) for c in [*pair, *_MOMENT_NAMES]), "_mean_a", "_mean_b")
    apart_a, apart_b = (F.when(F.col("n") > 0, F.col(m) - F.col(f"_{m}")) for m in ("mean_a", "mean_b"))
    tiny_a, tiny_b = (F.when(F.abs(d) <= 1e-15 * F.abs(F.col(m)), 0.0).otherwise(d) for d, m in ((apart_a, "mean_a"), (apart_b, "mean_b")))  # the rounding of a mean of equal means
    sums = both.groupBy(*pair).agg(
        F.sum(F.col("m2_a") + F.col("n") * tiny_a * tiny_a).alias("_va"), F.sum(F.col("m2_b") + F.col("n") * tiny_b * tiny_b).alias("_vb"),
        F.sum(F.col("c") + F.col("n") * tiny_a * tiny_b).alias("_vc"), F.sum("bad").alias("_bad"))
    r = F.when(F.col("_bad") == 0, per(F.col("_vc"), F.sqrt("_va") * F.sqrt("_vb")))
    named = F.array(*(F.lit(c) for c in names))
    return sums.select(*by, F.get(named, F.col("a").cast("int")).alias("feature_a"), F.get(named, F.col("b").cast("int")).alias("feature_b"), F.coalesce(r, F.lit(float("nan"))).alias("correlation"))


def strong_correlations(df: DataFrame, columns: Sequence[str], limit: float = 0.7) -> DataFrame:
    r = F.col("correlation")
    return correlation_matrix(df, columns).where(~F.isnan(r) & (F.abs(r) > limit)).orderBy(F.desc("correlation"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed on the right: count and density of every bin.

    NULL, NaN and infinite values are left out.  One distinct value gives a range of one around it; no value, no bins.
    """
    value = _known(column)
    finite = df.select(F.when(F.abs(value) < float("inf"), value).alias("_v")).where("_v is not null")
    ends = finite.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("_v").alias("n")).where("n > 0")
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(F.struct("n", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(flat, 1.0).otherwise(F.col("hi") - F.col("lo")).alias("span")).alias("ends"))
    end = ends.scalar()
    number = F.least(F.floor((F.col("_v") - end["lo"]) / end["span"] * bins).cast("int"), F.lit(bins - 1))
    counts = finite.groupBy(number.alias("bin")).agg(F.count("*").alias("count"))
    every = ends.select("ends.*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = F.col("span") / bins
    return every.join(counts, "bin", "left").select(  # a row per bin
        "bin", (F.col("lo") + F.col("bin") * width).alias("lower"), F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        (F.coalesce("count", F.lit(0)) / F.col("n") / width).alias("density"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).withColumn(
        "share_pct", F.col("count") / total * 100
    )


def split_summary(df: DataFrame, split: str, label: str, ts: str) -> DataFrame:
    """Per split: rows, share, spikes, spike rate, normals and time span."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("spikes"),
        (F.avg(label) * 100).alias("spike_rate"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
    ).withColumns({"normals": F.col("rows") - F.col("spikes"), "share_pct": F.col("rows") / total * 100})


def time_range(df: DataFrame, ts: str) -> DataFrame:
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        ((F.max(us) - F.min(us)) / _MICROS).alias("seconds"), F.count(F.lit(1)).alias("rows"),
    )


def rolling_mean(df: DataFrame, column: str, ts: str, tiebreak: str, chunk_rows=None) -> DataFrame:
    """Mean of the last min(100, n // 10) rows, NULL until that many exist; no rows unless n > 20."""
    base = df.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    split = split_ordered(base.select("_us", tiebreak), [], ["_us", tiebreak], chunk_rows=chunk_rows)
    if split.total_rows <= 20:
        return df.select(ts, tiebreak, column, F.lit(None).cast("double").alias("rolling_mean")).limit(0)
    size = min(100, split.total_rows // 10)
    w = Window.partitionBy(*split.keys).orderBy("_us", tiebreak)
    frame = w.rowsBetween(-(size - 1), Window.currentRow)
    return (
        split.with_halo(base, rows_before=size)
        .withColumn("rolling_mean", F.when(
            F.row_number().over(w) + F.col("_base") >= size, F.avg(_known(column)).over(frame)
        ))
        .where("_own").select(ts, tiebreak, column, "rolling_mean")
    )
