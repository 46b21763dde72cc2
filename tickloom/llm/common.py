"""Shared by the operators of this subpackage: words, ASCII case folding, literal tables, chunked tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import written

#: The bytes that part words, 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(text: str = "text") -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def flat(text: Column) -> Column:
    """Every blank as one space; the number of characters stays."""
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def words(text: Column) -> Column:
    return F.array_remove(F.split(flat(text), " "), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is.  Pure ASCII takes the byte-wise path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with underscores behind it as long as a column bears that name (names differ by more than their case)."""
    while wanted.lower() in {t.lower() for t in taken}:
        wanted += "_"
    return wanted


def literal_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table from the driver, as a literal of the plan (no Python or RDD on the executors)."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def slot_among(key: Column, splitters: list[str]) -> Column:
    """How many of the sorted ``splitters`` are below ``key``, by halving."""
    if not splitters:
        return F.lit(0)
    table = F.from_json(F.lit(json.dumps(splitters)), "array<string>")
    steps = [1 << i for i in reversed(range(len(splitters).bit_length()))]

    def search(k: Column) -> Column:
        def step(at: Column, by: Column) -> Column:
            beyond = (at + by <= len(splitters)) & (F.get(table, F.least(at + by, F.lit(len(splitters))) - 1) < k)
            return F.when(beyond, at + by).otherwise(at)

        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)

    return let(key, search)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_chunks(df: DataFrame, order: list, label: str) -> DataFrame:
    """``df`` written in ``order`` with its place as ``chunk``: chunks hold consecutive rows of about equal number.

    The range partitioner samples the whole order key; a key that ends in an identifier splits any hot value.  The chunk
    number is stored, so a repeated task cannot change it.
    """
    spread = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    return written(spread.withColumn("chunk", F.spark_partition_id()), label)
