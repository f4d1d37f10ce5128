"""Registry of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round aggregate columns: sums of doubles differ in the last digits by order."""
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})
