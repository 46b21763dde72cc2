"""Source divergence audit: how far the word use of sources is apart, priced from joint tables of count levels.

1. Workers count terms in numpy, straight from the bytes of the texts; counts per (part, source, term) are summed by Spark.
2. A term's share in a group depends only on its count there, so groups are compared by *levels*: the indicator matrix X has a
   row per term and a column per (group, count > 0).  X'X holds, for every pair of columns, how many terms have both: all joint
   tables of all pairs of groups at once.  X is sparse; its product is worked out in integers, block by block of terms, each
   block holding at most ``PAIRS`` products, and Spark sums the blocks.
3. The columns of count 0 would fill the matrix; what they would hold follows from the margins (the diagonal of X'X).
4. A joint table's cells are priced in whole numbers, in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import text_of
from tickloom.session import written

#: Terms are kept from so many documents of their part on; shares are in billionths; ranks of single terms.
LEAST_DOCS, SCALE, RANKS = 10, 1_000_000_000, 10
#: Bytes of text cut into terms at a time; counted (group, term) pairs that a worker holds; products of a block.
AT_ONCE, HELD, PAIRS = 2 << 20, 1 << 19, 1 << 21

#: Letters in lower case, bytes of other scripts as they are, 0 for all else.
_LETTER = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], dtype=np.uint8)


def cut_terms(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts that lie one after another in ``data``, and the number of each one's text."""
    letters = _LETTER[data]
    is_letter = letters != 0
    begins, ends = is_letter.copy(), is_letter.copy()
    begins[1:] &= ~is_letter[:-1]
    ends[:-1] &= ~is_letter[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = is_letter[inner]  # a text's first letter begins a term, its last one ends it
    ends[inner - 1] = is_letter[inner - 1]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters[is_letter].tobytes())])
    return terms, np.searchsorted(bounds, starts, "right") - 1


class _Counts:
    """Occurrences and documents per (group, term), summed in the worker until HELD pairs are there."""

    def __init__(self) -> None:
        self.held: list[pa.Table] = []
        self.rows = 0

    def add(self, table: pa.Table) -> None:
        self.held.append(table)
        self.rows += len(table)

    def take(self) -> pa.Table:
        whole = pa.concat_tables(self.held).group_by(["part", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
        self.held, self.rows = [], 0
        return whole.rename_columns(["part", "source", "term", "n", "docs"])


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, source, term, n, docs`` of ``part, source, text`` (bytes, no nulls); a group's term may come several times."""
    counts = _Counts()
    for batch in batches:
        texts = batch.column("text")
        _, bounds, data = texts.buffers()
        offsets = np.frombuffer(bounds, dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, dtype=np.int64)
        data = np.frombuffer(data or b"", dtype=np.uint8)
        groups = pa.Table.from_batches([batch.select(["part", "source"])])
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + AT_ONCE, "right")) - 1)
            terms, doc = cut_terms(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
            if len(terms):
                coded = terms.dictionary_encode()
                keys, n = np.unique(doc * np.int64(len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
                doc, code = np.divmod(keys, len(coded.dictionary))
                own = groups.slice(low, high - low).take(pa.array(doc))
                counts.add(own.append_column("term", coded.dictionary.take(pa.array(code))).append_column("n", pa.array(n.astype(np.int64))).append_column(
                    "docs", pa.array(np.ones(len(n), dtype=np.int64))))
            low = high
            if counts.rows > HELD:
                counts.add(counts.take())
                if counts.rows > HELD // 2:
                    yield from counts.take().to_batches(max_chunksize=1 << 16)
    if counts.held:
        yield from counts.take().to_batches(max_chunksize=1 << 16)


def kept_terms(docs: DataFrame, part_col: str, source_col: str, text_col: str, least: int) -> DataFrame:
    """``part, term, n`` (occurrences in the part) and ``counts``, an array of (source, n): a row per kept term of each part."""
    texts = docs.select(F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), text_of(text_col).cast("binary").alias("text"))
    counted = texts.mapInArrow(count_terms, "part string, source string, term binary, n long, docs long")
    # one exchange: both steps group by what it deals out, or by more.  A term brings a row per source and flush of a worker
    summed = counted.repartition("part", "term").groupBy("part", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = summed.groupBy("part", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return written(by_term.filter(F.col("docs") >= least).select("part", "term", "n", "counts"), "divergence-terms")


def _blocks(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive entries with at most PAIRS products together, or one entry."""
    upto, low = np.concatenate([[0], np.cumsum(size)]), 0
    while low < len(size):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + PAIRS, "right")) - 1)
        yield low, high
        low = high


def product(term: np.ndarray, column: np.ndarray, n_columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nonzero cells (i <= j, number) of X'X for the indicator matrix with ones at (term, column).

    A row's ones are multiplied with each other and the products summed per cell, all in integers.
    """
    order = np.lexsort((column, term))
    term, column = term[order], column[order].astype(np.int64)
    ends = np.searchsorted(term, term, "right")
    reach = ends - np.arange(len(term))  # each entry meets itself and the later ones of its row
    keys, numbers = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for low, high in _blocks(reach):
        here = reach[low:high]
        left = np.repeat(np.arange(low, high), here)
        right = left + np.arange(len(left)) - np.repeat(np.cumsum(here) - here, here)
        key, number = np.unique(column[left] * n_columns + column[right], return_counts=True)
        keys.append(key)
        numbers.append(number)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    number = np.zeros(len(key), dtype=np.int64)
    np.add.at(number, at, np.concatenate(numbers))
    return key // max(n_columns, 1), key % max(n_columns, 1), number


def _cells(part: str, counts: pa.ListArray) -> Iterator[pa.RecordBatch]:
    """The cells of the joint tables of some terms of one part."""
    term = np.repeat(np.arange(len(counts)), np.diff(counts.offsets.to_numpy()))
    entries = counts.flatten()
    coded = entries.field("source").dictionary_encode()
    by_name = np.array(pc.array_sort_indices(coded.dictionary.cast(pa.binary())))  # bytes: the order of UTF-8
    rank = np.empty(len(by_name), dtype=np.int64)
    rank[by_name] = np.arange(len(by_name))
    names = coded.dictionary.take(pa.array(by_name))
    group, level = rank[coded.indices.to_numpy()], entries.field("n").to_numpy()
    levels, of_level = np.unique(level, return_inverse=True)
    columns, column = np.unique(group * len(levels) + of_level, return_inverse=True)
    i, j, number = product(term, column, len(columns))
    of, value = columns // len(levels), levels[columns % len(levels)]
    yield pa.RecordBatch.from_arrays([
        pa.array([part] * len(i), pa.string()), names.take(pa.array(of[i])), pa.array(value[i]), names.take(pa.array(of[j])), pa.array(value[j]), pa.array(number),
    ], names=["part", "g", "a", "h", "b", "number"])


def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``part, counts`` sorted by part; each part's rows of a batch are one block of the matrix."""
    for batch in batches:
        parts = batch.column("part").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)] if len(parts) else [0]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            counts = batch.column("counts").slice(low, high - low)
            yield from _cells(parts[low], pa.ListArray.from_arrays(pa.array(counts.offsets.to_numpy() - counts.offsets[0].as_py()), counts.flatten()))


def joint_tables(terms: DataFrame) -> DataFrame:
    """``part, g, a, h, b, number``: how many terms occur a times in g and b times in h; g before h, or the same, a and b above 0."""
    rows = terms.select("part", "counts").sortWithinPartitions("part")
    cells = rows.mapInArrow(multiply, "part string, g string, a long, h string, b long, number long")
    return written(cells.groupBy("part", "g", "h", "a", "b").agg(F.sum("number").alias("number")), "divergence-cells")


def share(count: Column, whole: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / whole), exact for counts below 9e13; beyond, the long arithmetic fails loudly."""
    first = (count + 2) * 100_000
    rest = F.call_function("mod", first, whole) * (SCALE // 100_000)
    return 1 + _div(first, whole) * (SCALE // 100_000) + _div(rest, whole)


def _div(a: Column, b: Column) -> Column:
    """Whole division of longs that are not negative."""
    return F.call_function("div", a, b)


def price(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _pairs(groups: DataFrame, margins: DataFrame, cells: DataFrame) -> DataFrame:
    """``part, source, item, value`` for each ordered pair of groups of a part.

    With f(a, b) the price of a cell and 0 the level of terms that a group lacks, the sum over all V terms is
    V f(0,0) + sum over g's levels of (f(a,0) - f(0,0)) + the same of h + sum over the cells of (f(a,b) - f(a,0) - f(0,b) + f(0,0)).
    """
    g = groups.select("part", F.col("source").alias("g"), F.col("whole").alias("g_whole"), "v")
    h = groups.select("part", F.col("source").alias("h"), F.col("whole").alias("h_whole"))
    pairs = written(g.join(h, "part").filter("g != h and v > 0"), "divergence-pairs")  # as many rows as the result

    p0, q0 = share(F.lit(0).cast("long"), F.col("g_whole")), share(F.lit(0).cast("long"), F.col("h_whole"))
    pa_, qb = share(F.col("a"), F.col("g_whole")), share(F.col("b"), F.col("h_whole"))
    none = pairs.select("part", "g", "h", (F.col("v") * price(p0, q0)).alias("x"))
    levels = margins.join(pairs, ["part", "g"])
    one = levels.select("part", "g", "h", (F.col("number") * (price(pa_, q0) - price(p0, q0))).alias("x"))
    both = cells.filter("g != h").join(pairs, ["part", "g", "h"])
    two = both.select("part", "g", "h", (F.col("number") * (price(pa_, qb) - price(pa_, q0) - price(p0, qb) + price(p0, q0))).alias("x"))

    def swapped(df: DataFrame) -> DataFrame:
        return df.select("part", F.col("h").alias("g"), F.col("g").alias("h"), "x")

    # f is symmetric: g's levels count for (g, h) and (h, g), and the cells are stored once
    added = none.unionByName(one).unionByName(swapped(one)).unionByName(two).unionByName(swapped(two)).groupBy("part", "g", "h").agg(F.sum("x").alias("value"))
    empty = g.join(h, "part").filter("g != h and v = 0").select("part", "g", "h", F.lit(0).cast("long").alias("value"))
    return added.unionByName(empty).select("part", F.col("g").alias("source"), F.col("h").alias("item"), "value")


def _single_terms(terms: DataFrame, groups: DataFrame, parts: DataFrame) -> DataFrame:
    """``part, source, item, value`` of terms that a group uses more than its part does."""
    entries = terms.join(parts, "part").select("part", "term", share(F.col("n"), F.col("part_whole")).alias("q"), F.explode("counts").alias("x"))
    entries = entries.select("part", "term", "q", "x.source", F.col("x.n").alias("c")).join(groups.select("part", "source", "whole"), ["part", "source"])
    priced = entries.withColumn("p", share(F.col("c"), F.col("whole"))).filter("p > q")
    return priced.select("part", "source", F.col("term").cast("string").alias("item"), price(F.col("p"), F.col("q")).alias("value"))


def source_divergence(
    docs: DataFrame, part_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS, ranks: int = RANKS,
) -> DataFrame:
    """``part, source, kind, item, value, rank``: per group its distance from each other source of the part (kind ``pair``), and
    the terms that set it apart from the whole part (kind ``term``, the first ``ranks``).

    Terms are runs of letters A-Z (taken in lower case) and of characters beyond ASCII; a part keeps those in ``least_docs`` of
    its documents or more.  Null texts, parts and sources count as empty; rows that repeat an id are documents of their own.  A
    part without kept terms has distances of 0 and no terms; a group without kept terms is compared as one that has none.  Only
    the three columns are read.  An empty table gives no rows.
    """
    terms = kept_terms(docs, part_col, source_col, text_col, least_docs)
    cells = joint_tables(terms)
    margins = cells.filter("g = h").select("part", "g", "a", "number")
    totals = margins.groupBy("part", "g").agg(F.sum(F.col("a") * F.col("number")).alias("n"))
    # a written table's size is known, so small ones are broadcast and large ones joined by key
    sizes = written(terms.groupBy("part").agg(F.count("*").alias("v"), F.sum("n").alias("part_n")), "divergence-parts")
    there = docs.select(F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.coalesce(F.col(source_col), F.lit("")).alias("source")).distinct()
    named = totals.withColumnRenamed("g", "source")
    groups = there.join(named, ["part", "source"], "left").join(sizes, "part", "left").select(
        "part", "source", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("n", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("whole"))
    groups = written(groups, "divergence-groups")
    parts = sizes.select("part", (F.col("part_n") + 2 * F.col("v")).alias("part_whole"))

    ranked = Window.partitionBy("part", "source").orderBy(F.desc("value"), "item")
    single = _single_terms(terms, groups, parts).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= ranks)  # cut in each task first
    pair = _pairs(groups, margins, cells).withColumn("rank", F.row_number().over(ranked))
    return pair.withColumn("kind", F.lit("pair")).unionByName(single.withColumn("kind", F.lit("term"))).select("part", "source", "kind", "item", "value", "rank")
