"""Ordered work on hot keys: cut each key's order into chunks of bounded size.

Rolling features, lags, ranks and cumulative sums all need rows in order.  ``Window.partitionBy(key)``
puts a whole key into one task, which fails when one key holds a third of the table.  ``split_ordered``
looks at the row counts per key, and only for keys above the target size it counts rows per slice of the
order column, until every slice is small.  The driver receives nothing but those slice counts, at most
``SLICES_PER_CHUNK * MAX_CHUNKS`` per level.  They are joined back as a broadcast table of that
bounded size, so the rows themselves are shuffled once, by (key, chunk).

NULL comes before every value and NaN after them, in cut and uncut keys alike.  A double is cut by its class first (minus
infinity, finite, infinity, NaN), then by its value, so rows of one class that is one value are cut by the columns that follow.
Slices hold equal order values together and follow the order, so

* rows before a slice  = sum of the counts of the slices before it,
* rows needed from earlier chunks (a halo) = the slices just before the chunk.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

MAX_CHUNKS = 131_072
SLICES_PER_CHUNK = 16
MIN_CHUNK_ROWS = 25_000
MAX_CHUNK_ROWS = 100_000
MAX_LEVELS = 64


@dataclass
class _Slice:
    group: tuple
    path: tuple[int, ...]
    rows: int
    low: tuple
    high: tuple
    nulls: tuple
    first: float | int | None  # least value of the first order column
    last: tuple | None  # order values of the last row, where asked for
    sums: tuple
    rows_before: int = 0
    sums_before: tuple = ()
    chunk: int = 0


@dataclass
class OrderedSplit:
    """Result of :func:`split_ordered`: which slice of which key belongs to which chunk."""

    by: list[str]
    order: list[str]
    measures: dict[str, Column]
    total_rows: int
    chunk_rows: int
    levels: list[list[tuple]] = field(default_factory=list)
    groups: dict[tuple, list[_Slice]] = field(default_factory=dict)

    @property
    def is_cut(self) -> bool:
        return bool(self.groups)

    @property
    def keys(self) -> list[str]:
        """Columns that name one chunk: use them as window partition."""
        return [*self.by, "_chunk"] if self.is_cut else list(self.by)

    def gather(self, df: DataFrame) -> DataFrame:
        """Shuffle once by chunk, so that every window over ``keys`` and more columns needs no further shuffle."""
        return df.repartition(*self.keys) if self.keys else df

    # -- slice numbers -------------------------------------------------------------------------
    def _with_paths(self, df: DataFrame, levels: int | None = None, inner_last: bool = False) -> DataFrame:
        levels = len(self.levels) if levels is None else levels
        for level in range(levels):
            df = self._with_level(df, level, "inner" if inner_last and level == levels - 1 else "left")
        return df

    def _with_level(self, df: DataFrame, level: int, how: str) -> DataFrame:
        spark = df.sparkSession
        keys = _order_keys(df, self.order)
        schema = T.StructType(
            [T.StructField(f"_s_{c}", df.schema[c].dataType) for c in self.by]
            + [T.StructField(f"_s_{i}", T.IntegerType()) for i in range(level)]
            + [T.StructField("_s_which", T.IntegerType())]
            + [T.StructField(f"_s_low{i}", k.kind) for i, k in enumerate(keys)]
            + [T.StructField("_s_span", T.DoubleType()), T.StructField("_s_cells", T.IntegerType())]
        )
        on = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in self.by]
        on += [F.col(f"_p{i}") == F.col(f"_s_{i}") for i in range(level)]
        if on:
            nodes = spark.createDataFrame(self.levels[level], schema)
            joined = df.join(F.broadcast(nodes), _all(on), how)
        else:  # the whole table is one key: its single node is a literal
            joined = df.select(
                "*", *(F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema, self.levels[level][0]))
            )
        offset = F.lit(None).cast("double")
        for i, k in reversed(list(enumerate(keys))):
            offset = F.when(F.col("_s_which") == i, _distance(k.value, F.col(f"_s_low{i}"), k.kind)).otherwise(offset)
        cell = F.when(offset.isNotNull(), F.least(
            F.floor(offset / F.col("_s_span") * F.col("_s_cells")).cast("int"), F.col("_s_cells") - F.lit(1)
        ))  # NULLs: -1, the first slice
        return joined.withColumn(f"_p{level}", F.coalesce(cell, F.lit(-1))).drop(*schema.fieldNames())

    def _slice_table(self, df: DataFrame, rows: list[tuple], extra: list[T.StructField]) -> DataFrame:
        schema = T.StructType(
            [T.StructField(f"_t_{c}", df.schema[c].dataType) for c in self.by]
            + [T.StructField(f"_t_{i}", T.IntegerType()) for i in range(len(self.levels))]
            + extra
        )
        return df.sparkSession.createDataFrame(rows, schema)

    def _join_slices(self, df: DataFrame, rows: list[tuple], extra: list[T.StructField]) -> DataFrame:
        depth = len(self.levels)
        located = self._with_paths(df)
        table = self._slice_table(df, rows, extra)
        on = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in self.by]
        on += [F.col(f"_p{i}") == F.col(f"_t_{i}") for i in range(depth)]
        drop = [f"_t_{c}" for c in self.by] + [f"_t_{i}" for i in range(depth)] + [f"_p{i}" for i in range(depth)]
        return located.join(F.broadcast(table), _all(on), "left").drop(*drop)

    def _padded(self, path: tuple[int, ...]) -> tuple[int, ...]:
        return path + (-1,) * (len(self.levels) - len(path))

    # -- use -----------------------------------------------------------------------------------
    def assign(
        self, df: DataFrame, wanted: Callable[[int], Iterable[int]] | None = None, kept: Callable[[list[_Slice]], list[bool]] | None = None,
    ) -> DataFrame:
        """Add ``_chunk`` and, per measure m, ``_before_m`` / ``_all_m`` (NULL for keys that were not cut)
        and ``_next_low``, the first order value of the following chunk.

        ``wanted`` names, from a key's row count, the 0-based ranks of interest: of the keys that were cut only the
        chunks holding such a rank are kept, so that few rows go on into a shuffle.  ``kept`` tells of a cut key's slices which
        to keep; each of them is then a chunk of its own.
        """
        first = _order_type(df, self.order[0])
        extra = [T.StructField("_chunk", T.IntegerType()), T.StructField("_next_low", first)]
        if wanted or kept:
            extra.append(T.StructField("_wanted", T.BooleanType()))
        for m in self.measures:
            extra += [T.StructField(f"_before_{m}", T.DoubleType()), T.StructField(f"_all_{m}", T.DoubleType())]
        if not self.is_cut:
            return df.select(
                "*", F.lit(0).alias("_chunk"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in extra[1:])
            ).drop("_wanted")
        rows = []
        for group, slices in self.groups.items():
            stays = kept(slices) if kept else None
            chunk_of = {id(s): i if kept else s.chunk for i, s in enumerate(slices)}
            first_of: dict[int, _Slice] = {}
            for s in slices:
                first_of.setdefault(chunk_of[id(s)], s)
            if wanted:
                ranks = list(wanted(slices[-1].rows_before + slices[-1].rows))
                holding = {
                    s.chunk for s in slices if any(s.rows_before <= r < s.rows_before + s.rows for r in ranks)
                }
            totals = tuple(sum(s.sums[i] for s in slices) for i in range(len(self.measures)))
            for at, s in enumerate(slices):
                chunk = chunk_of[id(s)]
                nxt = first_of.get(chunk + 1)
                row = [*group, *self._padded(s.path), chunk, nxt.first if nxt else None]
                if wanted or kept:
                    row.append(stays[at] if kept else chunk in holding)
                for i in range(len(self.measures)):
                    row += [float(first_of[chunk].sums_before[i]), float(totals[i])]
                rows.append(tuple(row))
        out = self._join_slices(df, rows, extra)
        if wanted or kept:
            out = out.where(F.coalesce("_wanted", F.lit(True))).drop("_wanted")
        return out.withColumn("_chunk", F.coalesce("_chunk", F.lit(0)))

    def with_halo(self, df: DataFrame, rows_before: int = 0, rows_after: int = 0, span_before: int | None = None) -> DataFrame:
        """Add ``_chunk``, ``_base`` (rows of the key before the chunk's first copied row) and ``_own``.

        Every chunk also receives at least ``rows_before`` / ``rows_after`` neighbouring rows of its key, flagged
        ``_own = false``.  With ``span_before`` (needs a split with ``track_last``) it receives instead the slices that reach
        into so much of the first order column before its own begin, and of all that is older the very last row alone.
        """
        if not self.is_cut:
            return df.select("*", F.lit(0).alias("_chunk"), F.lit(0).cast("long").alias("_base"),
                             F.lit(True).alias("_own"))
        copy = T.StructType([
            T.StructField("chunk", T.IntegerType()), T.StructField("base", T.LongType()),
            T.StructField("own", T.BooleanType()), T.StructField("alone", T.BooleanType()),
        ])
        carries = span_before is not None
        rows = []
        for group, slices in self.groups.items():
            copies: list[list[tuple]] = [[] for _ in slices]
            start = 0
            while start < len(slices):
                end = start
                while end + 1 < len(slices) and slices[end + 1].chunk == slices[start].chunk:
                    end += 1
                left, right = start, end
                if carries:
                    left = _reached(slices, start, span_before)
                while left > 0 and slices[start].rows_before - slices[left].rows_before < rows_before:
                    left -= 1
                stop = slices[end].rows_before + slices[end].rows
                while right + 1 < len(slices) and slices[right + 1].rows_before < stop + rows_after:
                    right += 1
                carried = carries and left > 0
                base = slices[left].rows_before - int(carried)
                for i in range(left, right + 1):
                    copies[i].append((slices[start].chunk, base, start <= i <= end, False))
                if carried:
                    copies[left - 1].append((slices[start].chunk, base, False, True))
                start = end + 1
            rows += [(*group, *self._padded(s.path), copies[i], *([s.last] if carries else [])) for i, s in enumerate(slices)]
        extra = [T.StructField("_copies", T.ArrayType(copy))]
        if carries:
            extra.append(T.StructField("_last", T.StructType([df.schema[c] for c in self.order])))
        joined = self._join_slices(df, rows, extra)
        only = F.array(F.struct(F.lit(0).alias("chunk"), F.lit(0).cast("long").alias("base"),
                                F.lit(True).alias("own"), F.lit(False).alias("alone")))
        copied = joined.withColumn("_copy", F.explode(F.coalesce("_copies", only)))
        if carries:
            is_last = _all([F.col(c).eqNullSafe(F.col(f"_last.{c}")) for c in self.order])
            copied = copied.where(~F.col("_copy.alone") | is_last).drop("_last")
        return copied.withColumns(
            {"_chunk": F.col("_copy.chunk"), "_base": F.col("_copy.base"), "_own": F.col("_copy.own")}).drop("_copy", "_copies")


def _reached(slices: list[_Slice], start: int, span: int) -> int:
    """The first slice that reaches into ``span`` before the begin of slice ``start``."""
    begin, left = slices[start].low[0], start
    while begin is not None and left > 0 and slices[left - 1].high[0] is not None and slices[left - 1].high[0] >= begin - span:
        left -= 1
    return left


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _order_type(df: DataFrame, c: str) -> T.DataType:
    kind = df.schema[c].dataType
    return T.DoubleType() if isinstance(kind, (T.DoubleType, T.FloatType)) else T.LongType()


@dataclass(frozen=True)
class _Key:
    """A column of finite numbers to cut by, NULL where the order column is."""

    value: Column
    kind: T.DataType


def _order_keys(df: DataFrame, order: Sequence[str]) -> list[_Key]:
    """A double gives two keys, its class and its value; the value of a class that is one value is 0."""
    keys = []
    for c in order:
        if isinstance(_order_type(df, c), T.LongType):
            keys.append(_Key(F.col(c).cast("long"), T.LongType()))
            continue
        value = F.col(c).cast("double")
        infinite = F.lit(float("inf"))
        rank = F.when(F.isnan(value), 3).when(value == infinite, 2).when(value == -infinite, 0).otherwise(1)
        keys.append(_Key(F.when(value.isNotNull(), rank.cast("long")), T.LongType()))
        keys.append(_Key(F.when(value.isNotNull(), F.when(rank == 1, value).otherwise(0.0)), T.DoubleType()))
    return keys


def _cuttable(node: _Slice, keys: Sequence[_Key]) -> tuple[int, float]:
    """The first key on which the rows of a slice differ, and their distance there (0: cannot be cut).

    A key with NULLs beside one value is cut at distance 1: NULLs, then the value.
    """
    for i, (low, high) in enumerate(zip(node.low, node.high)):
        if node.nulls[i] == node.rows:
            continue
        if low < high:
            return i, _distance(high, low, keys[i].kind)
        if node.nulls[i]:
            return i, 1.0
    return 0, 0.0


def _distance(high, low, kind: T.DataType):
    """high - low as a double; of doubles half of it, which cannot overflow."""
    if isinstance(kind, T.DoubleType):
        return high / 2 - low / 2
    return (high - low).cast("double") if isinstance(high, Column) else float(high - low)


def split_ordered(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    measures: dict[str, Column] | None = None,
    chunk_rows: int | None = None,
    refine: Callable[[list[_Slice]], list[bool]] | None = None,
    track_last: bool = False,
) -> OrderedSplit:
    """Cut every key of ``by`` with more than ``chunk_rows`` rows into chunks along ``order``.

    ``order`` columns are numeric; rows that agree on all of them stay together.  ``measures``
    are additive columns whose totals before each chunk are wanted (see :meth:`OrderedSplit.assign`).  ``refine`` tells of all
    slices of a cut key, in order, which are worth cutting further (large ones; all are, if it is not given).

    A table of more than MAX_CHUNKS chunks gets larger chunks; they are sorted and summed in tasks that may spill.
    """
    by, order, measures = list(by), list(order), dict(measures or {})
    keys = _order_keys(df, order)
    counts = [F.count(F.lit(1)).alias("_rows")]
    for i, k in enumerate(keys):
        counts += [F.min(k.value).alias(f"_low{i}"), F.max(k.value).alias(f"_high{i}"), F.count_if(k.value.isNull()).alias(f"_nulls{i}")]
    counts.append(F.min(F.col(order[0]).cast(_order_type(df, order[0]))).alias("_first"))
    if track_last:
        counts.append(F.max(F.struct(*order)).alias("_last"))
    counts += [F.sum(e).cast("double").alias(f"_m{i}") for i, e in enumerate(measures.values())]

    def slice_of(row, path: tuple[int, ...]) -> _Slice:
        return _Slice(
            tuple(row[c] for c in by), path, row["_rows"],
            *(tuple(row[f"{side}{i}"] for i in range(len(keys))) for side in ("_low", "_high", "_nulls")), row["_first"],
            tuple(row["_last"]) if track_last and row["_last"] is not None else None,
            tuple(row[f"_m{i}"] or 0.0 for i in range(len(measures))),
        )

    stats = df.groupBy(*by).agg(*counts)
    if by:
        total, largest = stats.agg(F.sum("_rows"), F.max("_rows")).first()
        total, largest = total or 0, largest or 0
    else:
        whole = stats.first()
        total = largest = whole["_rows"]
    if chunk_rows is None:
        tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
        chunk_rows = min(max(MIN_CHUNK_ROWS, math.ceil(total / tasks)), MAX_CHUNK_ROWS)
    chunk_rows = max(chunk_rows, math.ceil(total / MAX_CHUNKS))
    split = OrderedSplit(by, order, measures, total, chunk_rows)
    if largest <= chunk_rows:
        return split

    # at most total / chunk_rows <= MAX_CHUNKS keys can be above chunk_rows
    hot = stats.where(F.col("_rows") > chunk_rows).collect() if by else [whole]
    open_nodes = [slice_of(r, ()) for r in hot]
    done: list[_Slice] = []
    for level in range(MAX_LEVELS):
        nodes, splittable = [], []
        for node in open_nodes:
            which, span = _cuttable(node, keys)
            if not span:  # one single order value: nothing left to cut
                done.append(node)
                continue
            cells = math.ceil(SLICES_PER_CHUNK * node.rows / chunk_rows)
            nodes.append((*node.group, *node.path, which, *node.low, span, cells))
            splittable.append(node)
        if not nodes:
            break
        split.levels.append(nodes)
        cells_df = split._with_paths(df, level + 1, inner_last=True)
        path_cols = [f"_p{i}" for i in range(level + 1)]
        found = [
            slice_of(r, tuple(r[p] for p in path_cols))
            for r in cells_df.groupBy(*by, *path_cols).agg(*counts).collect()
        ]
        worth = _worth(done + found, refine) if refine else None
        opened = [s.rows > chunk_rows and (worth is None or id(s) in worth) for s in found]
        open_nodes = [s for s, is_open in zip(found, opened) if is_open]
        done += [s for s, is_open in zip(found, opened) if not is_open]
        if not open_nodes:
            break
    else:
        raise ValueError(f"slices of {max(s.rows for s in open_nodes)} rows are left after {MAX_LEVELS} refinements")

    if not split.levels:  # every hot key is one single order value
        return split
    split.groups = _in_order(done)
    for slices in split.groups.values():
        chunk, filled = 0, 0
        for s in slices:
            if filled and filled + s.rows > chunk_rows:
                chunk, filled = chunk + 1, 0
            s.chunk = chunk
            filled += s.rows
    return split


def _in_order(slices: list[_Slice]) -> dict[tuple, list[_Slice]]:
    """Slices by key, in order, with the rows and sums before each."""
    groups: dict[tuple, list[_Slice]] = {}
    for s in sorted(slices, key=lambda s: s.path):
        groups.setdefault(s.group, []).append(s)
    for own in groups.values():
        before, sums = 0, (0.0,) * len(own[0].sums)
        for s in own:
            s.rows_before, s.sums_before = before, sums
            before += s.rows
            sums = tuple(a + b for a, b in zip(sums, s.sums))
    return groups


def _worth(slices: list[_Slice], refine: Callable[[list[_Slice]], list[bool]]) -> set[int]:
    found = set()
    for own in _in_order(slices).values():
        found |= {id(s) for s, good in zip(own, refine(own)) if good}
    return found


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "rn", **split_args) -> DataFrame:
    """Row number (from 1) within each key of ``by``, exact and without putting a key into one task."""
    split = split_ordered(df, by, order, **split_args)
    w = Window.partitionBy(*split.keys).orderBy(*order)
    return (
        split.with_halo(df).withColumn(name, F.row_number().over(w) + F.col("_base")).drop("_chunk", "_base", "_own")
    )


def cumulative(
    df: DataFrame, by: Sequence[str], value: str, measures: dict[str, Column], descending: bool = False,
    chunk_rows: int | None = None, wanted: Callable[[int], Iterable[int]] | None = None,
    kept: Callable[[list[_Slice]], list[bool]] | None = None,
) -> DataFrame:
    """One row per (key, distinct value) with each measure m, its running total ``cum_m`` up to and including the
    value in ascending (or descending) order, the key's total ``all_m``, and ``next_value``, the next larger value.

    With ``wanted`` (see :meth:`OrderedSplit.assign`) only the surroundings of those ranks are returned for large keys.  With
    ``kept`` only the slices that it keeps are cut further, and returned; ``next_value`` is not known then.
    """
    by = list(by)
    split = split_ordered(df, by, [value], measures, chunk_rows, refine=kept)
    keep = [f"_before_{m}" for m in measures] + [f"_all_{m}" for m in measures] + ["_next_low"]
    per_value = (
        split.assign(df, wanted, kept)
        .groupBy(*split.keys, value)
        .agg(*(F.sum(e).cast("double").alias(m) for m, e in measures.items()), *(F.first(c).alias(c) for c in keep))
    )
    whole = Window.partitionBy(*split.keys)
    ordered = whole.orderBy(F.col(value).asc())
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = per_value.select(
        *by, value, *measures,
        *((F.coalesce(f"_before_{m}", F.lit(0.0)) + F.sum(m).over(running)).alias(f"cum_{m}") for m in measures),
        *(F.coalesce(f"_all_{m}", F.sum(m).over(whole)).alias(f"all_{m}") for m in measures),
        F.coalesce(F.lead(value).over(ordered), "_next_low").alias("next_value"),
    )
    if descending:
        out = out.withColumns({f"cum_{m}": F.col(f"all_{m}") - F.col(f"cum_{m}") + F.col(m) for m in measures})
    return out


def values_at(
    df: DataFrame, by: Sequence[str], value: str, ranks: dict[str, Callable[[int], int]],
    chunk_rows: int | None = None,
) -> DataFrame:
    """For each name the value at a 0-based rank given by the key's row count; one row per key, plus ``n``.

    A key that was cut takes part with the few chunks that hold a wanted rank, everything else stays where it is.
    The rules are applied to the driver's count of a cut key and to the count column of the others, so they are written
    with :func:`floor_of`, :func:`ceil_of` and arithmetic.
    """
    def wanted(n: int) -> list[int]:
        return [rule(n) for rule in ranks.values()]

    cum = cumulative(df, by, value, {"n": F.lit(1)}, chunk_rows=chunk_rows, wanted=wanted)
    picks = []
    for name, rule in ranks.items():
        rank = rule(F.col("all_n"))
        here = (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))
        picks.append(F.max(F.when(here, F.col(value))).alias(name))
    return cum.groupBy(*by).agg(F.max("all_n").cast("long").alias("n"), *picks)


def floor_of(x):
    return F.floor(x) if isinstance(x, Column) else math.floor(x)


def ceil_of(x):
    return F.ceil(x) if isinstance(x, Column) else math.ceil(x)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], chunk_rows: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key: ``n`` and one column per name in ``probs``.

    ``percentile`` would gather all distinct values of a key in one task; here the values around the wanted ranks
    are found by counting.
    """
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    ranks: dict[str, Callable] = {}
    for name, q in probs.items():
        ranks[f"_lo_{name}"] = lambda n, q=float(q): floor_of((n - 1) * q)
        ranks[f"_hi_{name}"] = lambda n, q=float(q): ceil_of((n - 1) * q)
    picked = values_at(known, by, value, ranks, chunk_rows)
    out = [F.col("n")]
    for name, q in probs.items():
        at = (F.col("n") - 1) * F.lit(float(q))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return picked.select(*by, *out)
