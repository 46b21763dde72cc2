"""Exact dedup by a content sort.

Splitters sampled from the keys deal the normalised texts out by range; each range is sorted (spilling to disk as needed), so
equal texts are neighbours, and each text is compared in full with the one before it.  The key is the begin of the text, then
its digest, then the id: a passage that many texts begin with, or a third of all rows with one text, spreads over ranges.
Runs that go on in the next range are joined by comparing the texts at the border.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import lower_ascii, partitions, slot_among, text_of
from tickloom.session import written

#: Characters of the text in the sort key; sampled keys for each range; ranges for each shuffle partition.
BEGIN, SAMPLED, RANGES = 32, 16, 2


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_sha256, group``: rows of one group have equal normalised texts (A-Z lower-cased; null counts as empty)."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    keyed = slim.select("id", lower_ascii(F.col("text")).alias("norm")).select("id", "norm", F.sha2("norm", 256).alias("text_sha256")).withColumn(
        "key", F.concat(F.rpad(F.substring("norm", 1, BEGIN), BEGIN, " "), "text_sha256")
    )
    full_key = F.concat("key", F.coalesce(F.col("id").cast("string"), F.lit("")))

    ranges = RANGES * partitions(spark)
    sampled = min(1.0, SAMPLED * ranges / max(1, docs.count()))
    keys = sorted((r[0] for r in keyed.sample(sampled, 17).select(full_key).collect()), key=str.encode)  # SAMPLED short keys per range
    splitters = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)} if keys else [], key=str.encode)

    order = Window.partitionBy("chunk").orderBy("key", "id")
    compared = keyed.withColumn("chunk", slot_among(full_key, splitters)).select(
        "chunk", "key", "id", "text_sha256", "norm",
        F.lag("norm").over(order).alias("previous"), F.lead("id", 1).over(order).alias("following"), F.row_number().over(order).alias("row"),
        F.lead(F.lit(True)).over(order).alias("more"),
    ).select(
        "chunk", "key", "id", "text_sha256", "row",
        F.when(F.col("previous") == F.col("norm"), 0).otherwise(1).alias("new"),
        F.when((F.col("row") == 1), F.col("norm")).alias("first_text"), F.when(F.col("more").isNull(), F.col("norm")).alias("last_text"),
    )
    runs = written(compared.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("key", "new"), "exact-runs")

    edges = runs.filter("first_text is not null or last_text is not null").groupBy("chunk").agg(
        F.max("run").alias("runs"), F.max("first_text").alias("first_text"), F.max("last_text").alias("last_text"),
    )
    numbered = written(edges, "exact-edges")
    number = numbered.select("chunk", F.row_number().over(Window.orderBy("chunk")).alias("no"))  # one narrow row per range
    ends = numbered.join(number, "chunk")
    borders = ends.select("no", "chunk", "runs", "first_text").join(
        ends.select((F.col("no") + 1).alias("no"), F.col("last_text").alias("text_before")), "no", "left",
    ).select("chunk", "runs", F.coalesce(F.col("first_text") == F.col("text_before"), F.lit(False)).cast("int").alias("goes_on"))
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = borders.select(
        "chunk", (F.coalesce(F.sum(F.col("runs") - F.col("goes_on")).over(before), F.lit(0)) - F.col("goes_on")).alias("groups_before"),
    )
    return runs.join(F.broadcast(offsets), "chunk").select(  # one row per range
        "id", "text_sha256", (F.col("run") + F.col("groups_before")).alias("group"),
    )


def exact_dedup(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256``, one row per document.

    Of equal texts the row with the smallest (or largest) id stays.  Null ids count as greater than none: a group of null ids
    keeps all its rows, a null id beside others goes.  Rows that repeat an id and text all stay or all go.  An empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: smallest or largest, not {keep!r}")
    grouped = written(content_groups(docs, id_col, text_col), "exact-grouped")
    best = F.min("id") if keep == "smallest" else F.max("id")
    repeated = written(grouped.groupBy("group").agg(best.alias("best"), F.count("*").alias("n")).filter("n > 1"), "exact-groups")
    joined = grouped.join(repeated, "group", "left")
    keep_id = F.when(F.col("n").isNotNull(), F.col("best")).otherwise(F.col("id"))
    return joined.select(
        "id", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"), "text_sha256",
    )
