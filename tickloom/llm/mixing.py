"""Mixing sources to target weights, by Pfair scheduling.

A source's documents, in a fixed pseudo-random order, form blocks of ``block_bytes``.  The target is the mix in which every
slot is shared by the weights of the sources that have something left: when each source has had V times its weight, or all its
blocks, T(V) = sum of min(w V, blocks) slots are filled.  The j-th block of a source of weight w is released at
floor(T((j - 1) / w)) and due at ceil(T(j / w)); the earliest deadline among the released blocks takes each slot.  The target
itself shares out every slot among windows, so the windows can be met, and earliest deadline first meets them: after any
number of slots every source is less than one block from its target.  Weights are taken as exact fractions.

The slots are worked out one after another by the driver, from the weights and block counts alone (microseconds a block), and
written stretch by stretch; the blocks' rows follow by join.
"""

from __future__ import annotations

import heapq
import math
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from functools import cmp_to_key
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import in_chunks, text_of
from tickloom.session import scratch_dir, written

#: Slots that the driver holds at a time; besides them it holds a row for each source, however many there are.
RESOLUTION = 1 << 18


def shares(weights: dict, slots: int) -> dict:
    """Whole shares of ``slots`` in proportion to the weights, at least one each, by largest remainders."""
    total = sum(weights.values())
    spare = slots - len(weights)
    exact = {s: spare * w / total for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], str(s)))[: slots - sum(out.values())]:
        out[s] += 1
    return out


def _whole(weights: list) -> list[int]:
    """Integers in exactly the proportion of the weights."""
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*[x.denominator for x in exact])
    found = [int(x * scale) for x in exact]
    common = math.gcd(*found)
    return [x // common for x in found]


def _served(blocks: list[int], weights: list[int]):
    """``T(j, i)``: numerator and denominator of the slots that the target has filled when source i has had j blocks."""
    ends = sorted(range(len(blocks)), key=cmp_to_key(lambda i, j: blocks[i] * weights[j] - blocks[j] * weights[i]))
    at = [blocks[i] / weights[i] for i in ends]
    ended = list(accumulate((blocks[i] for i in ends), initial=0))
    going = list(accumulate((-weights[i] for i in ends), initial=sum(weights)))
    last = len(ends) - 1

    def served(j: int, i: int) -> tuple[int, int]:
        w = weights[i]
        k = min(bisect_left(at, j / w), last)  # about so many sources have ended before; then exactly
        while k and j * weights[ends[k - 1]] < blocks[ends[k - 1]] * w:
            k -= 1
        while k < last and j * weights[ends[k]] > blocks[ends[k]] * w:
            k += 1
        return ended[k] * w + going[k] * j, w

    return served


def schedule(blocks: list[int], weights: list) -> Iterator[int]:
    """The source (by place in the lists) of each slot, earliest deadline first among the released blocks.

    Sources whose weight is not above zero follow when all others have ended, evenly.
    """
    wanted = [i for i, n in enumerate(blocks) if n > 0]
    for sources in ([i for i in wanted if weights[i] > 0], [i for i in wanted if not weights[i] > 0]):
        if not sources:
            continue
        counts = [blocks[i] for i in sources]
        served = _served(counts, _whole([weights[i] if weights[i] > 0 else 1 for i in sources]))

        def due(j: int, i: int) -> int:
            number, by = served(j, i)
            return -(-number // by)

        waiting = [(0, due(1, i), i, 1) for i in range(len(sources))]
        heapq.heapify(waiting)
        ready: list[tuple] = []
        for t in range(sum(counts)):
            while waiting and waiting[0][0] <= t:
                heapq.heappush(ready, heapq.heappop(waiting)[1:])
            _, i, j = heapq.heappop(ready)
            yield sources[i]
            if j < counts[i]:
                number, by = served(j, i)
                heapq.heappush(waiting, (number // by, due(j + 1, i), i, j + 1))


def cycle(of: dict) -> list[tuple]:
    """The source of each slot where every source has as many blocks as its weight."""
    names = list(of)
    return [names[i] for i in schedule(list(of.values()), list(of.values()))]


def stretches(blocks: list[int], weights: list, slots: int = RESOLUTION) -> Iterator[array]:
    """The schedule, ``slots`` slots at a time."""
    order = schedule(blocks, weights)
    while part := array("q", islice(order, slots)):
        yield part


def segments(blocks: dict, weights: dict, slots: int = RESOLUTION) -> list[dict]:
    """The schedule as stretches of at most ``slots`` slots: ``at`` (first slot), ``order`` (sources by slot), each gone through once.

    Of equal deadlines the source that stands first in ``weights`` goes first.
    """
    names, at, out = [s for s in weights if s in blocks], 0, []
    for part in stretches([blocks[s] for s in names], [weights[s] for s in names], slots):
        out.append({"at": at, "cycles": 1, "order": [names[i] for i in part]})
        at += len(part)
    return out


def timetable(spark: SparkSession, names: pa.Array, kind: T.DataType, blocks: list[int], weights: list, slots: int = RESOLUTION) -> DataFrame:
    """``p_source, p_block, slot`` of every block, written stretch by stretch; ``kind``: the type of a source."""
    path, at, placed = scratch_dir(spark, "mix-slots"), 0, [0] * len(blocks)
    for part in stretches(blocks, weights, slots):
        block = array("q")
        for i in part:
            block.append(placed[i])
            placed[i] += 1
        rows = pa.table({
            "p_source": names.take(pa.array(part, pa.int64())), "p_block": pa.array(block, pa.int64()), "slot": pa.array(range(at, at + len(part)), pa.int64())})
        spark.createDataFrame(rows).coalesce(1).write.mode("append").parquet(path)
        at += len(part)
    return spark.read.schema(T.StructType([T.StructField("p_source", kind), T.StructField("p_block", T.LongType()), T.StructField("slot", T.LongType())])).parquet(path)


def blocks_of(docs: DataFrame, block_bytes: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, source, size, mixed, text_hash, block``: bytes of the source's documents before, over ``block_bytes``.

    A document counts one byte more than its text; one longer than a block takes the numbers of the blocks that it fills.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.xxhash64(F.col(id_col), F.lit("mix")).alias("mixed"), F.xxhash64(text).alias("text_hash"),
    )
    order = ["source", "mixed", "id", "text_hash"]
    chunks = in_chunks(rows, order, "mix-order")
    per = chunks.groupBy("chunk", "source").agg(F.sum("size").alias("bytes"))  # chunks are sorted by source: about as many rows as chunks and sources
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(F.col("chunk").alias("o_chunk"), F.col("source").alias("o_source"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("chunk", "source").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = chunks.withColumn("upto", F.sum("size").over(inside))
    placed = counted.join(offsets, (F.col("chunk") == F.col("o_chunk")) & F.col("source").eqNullSafe(F.col("o_source")))
    block = F.floor((F.col("before") + F.col("upto") - F.col("size")) / block_bytes)
    return placed.select("id", "source", "size", "mixed", "text_hash", block.alias("block"))


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def mix_sources(
    docs: DataFrame, weights: dict | None = None, block_bytes: int = 64 << 20, slots: int = RESOLUTION,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``id, source, size, block, slot, text_hash, mixed``: every document once; sort by (slot, mixed, id, text_hash) to read the mix.

    ``weights``: source -> weight; without them the square root of a source's bytes.  A source without a weight takes the
    smallest one.  Null is a source of its own.  No row is dropped or repeated: small sources end, and the others share their
    part.  Sources may be any number, and of any type that can be sorted.  A document longer than a block stands at its first
    block's slot.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = written(blocks_of(docs, block_bytes, id_col, text_col, source_col), "mix-blocks")
    found = rows.groupBy("source").agg(F.max("block").alias("last"), F.sum("size").alias("bytes")).orderBy(F.col("source").asc_nulls_first()).toArrow()
    if not len(found):
        return rows.select("id", "source", "size", "block", F.lit(0).cast("long").alias("slot"), "text_hash", "mixed")
    names, sizes = found["source"].combine_chunks(), found["bytes"].to_pylist()
    weight = [weights.get(s, min(weights.values())) for s in names.to_pylist()] if weights else [n ** 0.5 for n in sizes]
    placed = timetable(spark, names, rows.schema["source"].dataType, [b + 1 for b in found["last"].to_pylist()], weight, slots)
    joined = rows.join(placed, _same(F.col("source"), F.col("p_source")) & (F.col("block") == F.col("p_block")))
    return joined.select("id", "source", "size", "block", "slot", "text_hash", "mixed")
