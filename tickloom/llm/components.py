"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import written


def _is_starred(links: DataFrame) -> bool:
    """Every node has one link at most, to a node that has none: each star is a component, around its least node."""
    twice = links.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
    inner = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
    return twice.unionByName(inner).isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's greater neighbours are linked to its least one."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")), "stars")  # plain on both sides: a hub can be split
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("low")), "stars")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``a, b``: each linked node but the least of its component, with that least one.

    Every step's result is a written table, so lost executors cost one step.  A node's links are never gathered in one row.
    """
    at = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    while not _is_starred(at):
        at = written(_small_star(written(_large_star(at), "links")), "links")
    return at
