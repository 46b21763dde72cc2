"""Sharding by the minimax contiguous partition.

Rows are ordered by the first identifier of their group (equal texts), so a group is one atomic, contiguous interval of the
running total of bytes.  The smallest feasible capacity is searched by halving; whether a capacity will do is checked
greedily.  A check needs the last group end at or below some 24 positions only, so the driver holds a bounded grid of group
ends (``CELLS`` cells, refined where a cut may fall) instead of all of them.  Among the partitions of that capacity the cuts
nearest to even shares are taken.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import in_chunks, text_of
from tickloom.session import written

#: 2 ** CELLS cells of the total at first; a cell in question is cut into 2 ** FINER.
CELLS, FINER = 14, 6


def laid_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """One row per document: id, size, text_crc32, and its place in the order of groups.

    ``upto`` and ``rows_upto`` are running totals including the row; ``last`` marks the end of a group.  Groups stand in
    the order of their smallest id (null first), ties by digest.  A null text has the size of an empty one and shares its group.
    """
    text = text_of(text_col)
    rows = written(docs.select(
        F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"),
        (F.octet_length(text).cast("long") + overhead).alias("size"), F.crc32(text).alias("text_crc32"),
    ), "sharding-rows")
    repeated = written(
        rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first", F.lit(True).alias("again")),
        "sharding-groups",
    )
    placed = rows.join(repeated, "digest", "left").withColumn("first", F.when(F.col("again"), F.col("first")).otherwise(F.col("id"))).drop("again")
    chunks = in_chunks(placed, ["first", "digest", "id"], "sharding-order")

    totals = chunks.groupBy("chunk").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min(F.struct("first", "digest"))["digest"].alias("begins"),
    )
    by_chunk = Window.orderBy("chunk")  # one row per chunk
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "chunk", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"), F.lead("begins").over(by_chunk).alias("next_begins"),
    )
    inside = Window.partitionBy("chunk").orderBy("first", "digest", "id")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = chunks.select(
        "id", "size", "text_crc32", "digest", "chunk", F.sum("size").over(upto).alias("upto"),
        F.row_number().over(inside).cast("long").alias("rows_upto"), F.lead("digest").over(inside).alias("next"),
    )
    return counted.join(F.broadcast(offsets), "chunk").select(  # as many rows as chunks
        "id", "size", "text_crc32", (F.col("upto") + F.col("bytes_before")).alias("upto"),
        (F.col("rows_upto") + F.col("rows_before")).alias("rows_upto"),
        (~F.col("digest").eqNullSafe(F.coalesce("next", "next_begins"))).alias("last"),
    )


class GroupEnds:
    """Known group ends, sorted, each with the number of ends hidden below it in its cell.

    ``split(shift, cells)`` returns ``(end, hidden, shift)`` for the cells ``(end - 1) >> shift`` within the wanted ones.
    """

    def __init__(self, total: int, split):
        self.total, self.split = total, split
        self.shift = max(0, total.bit_length() - CELLS)
        self._set(split(self.shift, None, None))

    def _set(self, known: list[tuple[int, int, int]]) -> None:
        self.known = sorted(known)
        self.ends = [k[0] for k in self.known]
        self.open: set[int] = set()

    def floor(self, x: int, hopeful: bool = False) -> int:
        """The last end at or below x; hopeful: what it could be at most."""
        i = bisect_right(self.ends, x)
        if i < len(self.ends) and self._may_hide(i, x):
            self.open.add(i)
            if hopeful:
                return x
        return self.ends[i - 1] if i else 0

    def ceil(self, x: int) -> int:
        """The first known end at or above x."""
        if x <= 0:
            return 0
        i = bisect_left(self.ends, x)
        if self.ends[i] != x and self.known[i][1]:
            self.open.add(i)
        return self.ends[i]

    def _may_hide(self, i: int, x: int) -> bool:
        end, hidden, shift = self.known[i]
        return hidden > 0 and x > (end - 1) >> shift << shift

    def between(self, low: int, high: int) -> set[int]:
        """Cells with hidden ends that could lie in [low, high]."""
        out, i = set(), bisect_left(self.ends, low)
        while i < len(self.ends):
            end, hidden, shift = self.known[i]
            if (end - 1) >> shift << shift >= high:
                break
            if hidden:
                out.add(i)
            i += 1
        return out

    def refine(self, wanted: set[int]) -> None:
        by_shift: dict[int, list[int]] = {}
        for i in wanted:
            by_shift.setdefault(self.known[i][2], []).append((self.ends[i] - 1) >> self.known[i][2])
        known = [k for i, k in enumerate(self.known) if i not in wanted]
        for shift, cells in by_shift.items():
            known += self.split(max(0, shift - FINER), shift, cells)
        self._set(known)


def greedy(ends: GroupEnds, capacity: int, shards: int, hopeful: bool) -> list[int]:
    cuts, at = [], 0
    for _ in range(shards):
        at = ends.floor(min(at + capacity, ends.total), hopeful)
        cuts.append(at)
    return cuts


def smallest_capacity(ends: GroupEnds, shards: int, hopeful: bool) -> int:
    low, high = -(-ends.total // shards), ends.total
    while low < high:
        middle = (low + high) // 2
        if greedy(ends, middle, shards, hopeful)[-1] >= ends.total:
            high = middle
        else:
            low = middle + 1
    return low


def minimax_cuts(ends: GroupEnds, shards: int) -> tuple[int, list[int]]:
    """The smallest largest shard, and the ends of all shards but the last."""
    while True:
        most, least = smallest_capacity(ends, shards, False), smallest_capacity(ends, shards, True)
        low, high = greedy(ends, least, shards, False), greedy(ends, most, shards, True)
        wanted = set().union(*(ends.between(p, q) for p, q in zip(low, high, strict=True)))
        if not wanted:
            break
        ends.refine(wanted)
    while True:
        ends.open.clear()
        earliest = [ends.total]
        for _ in range(shards - 1):  # from the right: the rest must still fit
            earliest.append(ends.ceil(earliest[-1] - most))
        cuts, at = [], 0
        for k in range(1, shards):
            even = ends.floor(ends.total * k // shards)
            at = max(earliest[shards - k], min(ends.floor(min(at + most, ends.total)), even))
            cuts.append(at)
        if not ends.open:
            return most, cuts
        ends.refine(set(ends.open))


def minimax_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """``id, size, text_crc32, shard, slot, capacity``: every row once, a group of equal texts in one shard.

    The largest shard is as small as any contiguous partition allows.  Shards stay empty where there are fewer groups; an
    empty table gives no rows.  Repeated rows are rows of one group and get slots of their own.
    """
    rows = written(laid_out(docs, id_col, text_col, overhead), "sharding-laid-out")
    total = rows.agg(F.max("upto")).first()[0] or 0
    if not total:
        return rows.select("id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("capacity"))

    def cell(shift: int) -> Column:
        return F.shiftright(F.col("upto") - 1, shift)

    def split(shift: int, parent: int | None, cells: list[int] | None) -> list[tuple[int, int, int]]:
        """At most 2 ** CELLS rows at first, then 2 ** FINER for each cell in question (a few for each cut)."""
        ends = rows.filter("last")
        if cells is not None:
            ends = ends.filter(cell(parent).isin(cells))
        found = ends.groupBy(cell(shift).alias("cell")).agg(F.max("upto").alias("end"), F.count("*").alias("n")).collect()
        return [(r["end"], r["n"] - 1, shift) for r in found]

    capacity, cuts = minimax_cuts(GroupEnds(total, split), shards)
    at = {r["upto"]: r["rows_upto"] for r in rows.filter(F.col("upto").isin(cuts)).select("upto", "rows_upto").collect()}  # one row per cut
    starts = [0, *(at.get(c, 0) for c in cuts)]
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    shard = F.size(F.filter(bounds, lambda c: c < F.col("upto")))
    return rows.withColumn("shard", shard).select(
        "id", "size", "text_crc32", "shard",
        (F.col("rows_upto") - 1 - F.get(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("shard"))).alias("slot"),
        F.lit(capacity).cast("long").alias("capacity"),
    )
