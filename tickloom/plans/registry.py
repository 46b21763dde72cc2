"""Registered queries: name -> (Spark query over the driver's tables, SQL with the same result)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def six(df: DataFrame, *columns: str, nine: tuple[str, ...] = ()) -> DataFrame:
    """Round the named columns (all doubles if none is named) to six digits.

    ``nine``: quantiles between two values of six digits, which may lie half-way at the seventh; nine digits hold them.
    """
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, 9 if c in nine else 6) for c in names})


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Times without zone, as the driver's tables hold them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def sql_six(columns: list[str], alias: str = "") -> str:
    return ", ".join(f"round({alias}{c}, 6) AS {c}" for c in columns)
