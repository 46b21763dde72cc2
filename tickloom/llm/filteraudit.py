"""Filter interaction audit: what each filter removes in every order of application, from sorted posting lists.

1. Documents are numbered in ascending id order.  Per part, range of ``RANGE`` numbers and filter the failing numbers are kept
   as a sorted list; so are the numbers of marked documents (good, toxic).  A range is one row, whatever a part's size.
2. Inside a range the union of every set of filters is a galloping k-way merge: the shorter list's members are searched in the
   longer one, the runs between them are copied whole.  Differences and intersections search in the same way.
3. Sizes add up over the ranges.  A filter's loss depends on the set of the earlier filters only, not on their order, so
   m * 2^(m-1) sizes per part give all m! orders.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import UPPER, let, literal_rows, partitions, text_of, words
from tickloom.session import written

#: Numbers of one range: the longest posting list.
RANGE_BITS = 16
#: Filters at most: their orders are listed one by one.
MOST_FILTERS = 7
#: The marks of the audit and the name of the count of each one that is lost.
LOST = {"good": "good_lost", "toxic": "toxic_lost"}


def held(members: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of the sorted ``members`` the sorted list ``among`` holds."""
    if not len(among):
        return np.zeros(len(members), dtype=bool)
    at = np.minimum(np.searchsorted(among, members), len(among) - 1)
    return among[at] == members


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Members of ``a`` that ``b`` does not hold; the shorter list is searched in the longer one."""
    if len(a) <= len(b):
        return a[~held(a, b)]
    at = np.searchsorted(a, b)
    common = at[(at < len(a)) & (a[np.minimum(at, len(a) - 1)] == b)]
    return np.delete(a, common)


def union(lists: list[np.ndarray]) -> np.ndarray:
    """K-way merge of sorted lists without repeats, the longest first: new members are inserted between copied runs."""
    merged = np.empty(0, dtype=np.int64)
    for one in sorted(lists, key=len, reverse=True):
        if not len(merged):
            merged = one
            continue
        at = np.searchsorted(merged, one)
        new = merged[np.minimum(at, len(merged) - 1)] != one
        merged = np.insert(merged, at[new], one[new])
    return merged


def sizes_of(lists: list[np.ndarray], marked: list[np.ndarray]) -> Iterator[tuple[int, ...]]:
    """``filter, earlier, gone, removed, marked ones among the removed`` for each filter and each set (as bits) of earlier filters.

    ``gone`` counts what the earlier filters and this one remove together.
    """
    m = len(lists)
    unions = [union([lists[k] for k in range(m) if earlier >> k & 1]) for earlier in range(1 << m)]
    for f in range(m):
        for earlier in range(1 << m):
            if not earlier >> f & 1:
                removed = difference(lists[f], unions[earlier])
                lost = [held(removed, x) if len(removed) <= len(x) else held(x, removed) for x in marked]
                yield f, earlier, len(unions[earlier | 1 << f]), len(removed), *[int(x.sum()) for x in lost]


def postings(rows: DataFrame, filters: list[str], marks: list[str]) -> DataFrame:
    """``part, range, n`` and a sorted list of numbers for each filter and mark.

    ``rows``: ``id, tie, part`` and a boolean column per filter and mark.  Numbers follow (id, tie); rows that repeat both are
    documents of their own.  The numbered table is written, so a repeated task cannot number anew.
    """
    lists = [*filters, *marks]
    bits = sum((F.coalesce(F.col(c), F.lit(False)).cast("int") * (1 << k) for k, c in enumerate(lists)), F.lit(0))
    spread = rows.select("id", "tie", "part", bits.alias("bits")).repartitionByRange(partitions(rows.sparkSession), "id", "tie").sortWithinPartitions("id", "tie")
    numbered = written(spread.select("part", "bits", F.monotonically_increasing_id().alias("no")), "audit-numbered")
    listed = [F.sort_array(F.collect_list(F.when(F.col("bits").bitwiseAND(1 << k) != 0, F.col("no")))).alias(c) for k, c in enumerate(lists)]
    ranged = numbered.withColumn("range", F.shiftright("no", RANGE_BITS))
    return written(ranged.groupBy("part", "range").agg(F.count("*").alias("n"), *listed), "audit-postings")


def joint_sizes(posted: DataFrame, filters: list[str], marks: list[str]) -> DataFrame:
    """``part, f, earlier, n, failing, gone, removed`` and a count per mark: one row per part, filter and set of earlier filters."""
    n_filters, lists = len(filters), [*filters, *marks]

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in lists]
            for i, (part, n) in enumerate(zip(batch.column("part").to_pylist(), batch.column("n").to_pylist(), strict=True)):
                own = [c[i].values.to_numpy() for c in columns]
                found = [(part, f, earlier, n, len(own[f]), *counts) for f, earlier, *counts in sizes_of(own[:n_filters], own[n_filters:])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=names)

    names = ["part", "f", "earlier", "n", "failing", "gone", "removed", *(f"lost_{m}" for m in marks)]
    schema = "part string, f long, earlier long, " + ", ".join(f"{c} long" for c in names[3:])
    sizes = posted.mapInArrow(merged, schema)
    return written(sizes.groupBy("part", "f", "earlier").agg(*[F.sum(c).alias(c) for c in names[3:]]), "audit-sizes")


def audit_filters(rows: DataFrame, filters: list[str], marks: list[str]) -> DataFrame:
    """One row per part, order of all filters and step: what the step's filter does after those before it.

    ``rows``: ``id, tie, part`` (no nulls in part), a boolean column per filter (true: fails) and per mark; null counts as false.
    Returned counts: ``kept`` after the step, ``removed`` by it, ``redundant`` (fails, but gone before), ``unique_fails`` (fails no
    other filter), ``lost_<mark>``, and ``shapley``: the filter's removals summed over all orders.  No rows give no parts.
    """
    if not 1 <= len(filters) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters")
    spark, m = rows.sparkSession, len(filters)
    sizes = joint_sizes(postings(rows, filters, marks), filters, marks)
    ways = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(m - 1 - k)) for k in range(m)]), F.bit_count("earlier") + 1)
    alone = F.max(F.when(F.bit_count("earlier") == m - 1, F.col("removed")))
    whole = sizes.groupBy("part", "f").agg(alone.alias("unique_fails"), F.sum(ways * F.col("removed")).alias("shapley"))

    steps = []
    for order in permutations(range(m)):
        for step in range(m):
            steps.append({"filter_order": "".join(filters[k] for k in order), "step": step + 1, "f": order[step], "earlier": sum(1 << k for k in order[:step])})
    # m! * m rows of a literal; m is bounded
    stepped = F.broadcast(literal_rows(spark, steps, "filter_order: string, step: int, f: bigint, earlier: bigint")).join(sizes, ["f", "earlier"])
    return stepped.join(whole, ["part", "f"]).select(
        "part", "filter_order", "step", (F.col("n") - F.col("gone")).alias("kept"), "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails", *[f"lost_{x}" for x in marks], "shapley")


def contract_filters(text: Column) -> dict[str, Column]:
    """What filters A to D ask of whole texts; ``counts``: words and distinct words, each text cut once."""
    counts = let(words(text), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("u")))
    capitals = F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
    return {"counts": counts, "C": 100 * capitals > 3 * F.char_length(text), "D": text.rlike(r"[#$%&*|]")}


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", quality_col: str = "quality", toxic_col: str = "toxic",
) -> DataFrame:
    """The audit of five filters over ``docs``: A under 200 words, B under half of the words distinct, C over 3 of 100 characters
    capitals, D a sign of ``#$%&*|``, E the text of a smaller id anywhere in the table.

    Null texts and parts count as empty.  Rows that repeat an id are documents of their own; their equal texts do not fail E, nor
    does a null id.  A document is good (toxic) if any label row of its id says 1; a null id has no labels.  Only the named
    columns are read.  An empty table gives no rows; an empty table of labels gives zeros.
    """
    text = text_of(text_col)
    measured = contract_filters(text)
    base = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("tie"),
        measured["counts"].alias("counts"), measured["C"].alias("C"), measured["D"].alias("D"))
    base = base.select("id", "part", "tie", (F.col("counts.n") < 200).alias("A"), (100 * F.col("counts.u") < 50 * F.col("counts.n")).alias("B"), "C", "D")
    base = written(base, "audit-documents")
    first = written(base.groupBy("tie").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select(F.col("tie").alias("r_tie"), "first"), "audit-repeated")
    marked = labels.groupBy(F.col(id_col).alias("m_id")).agg(
        F.max(F.coalesce(F.col(quality_col) == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col(toxic_col) == 1, F.lit(False))).alias("toxic"))
    rows = base.join(first, F.col("tie") == F.col("r_tie"), "left").withColumn("E", F.col("id") > F.col("first")).join(marked, F.col("id") == F.col("m_id"), "left")
    return audit_filters(rows, list("ABCDE"), list(LOST)).withColumnsRenamed({f"lost_{k}": v for k, v in LOST.items()})
