"""Named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its row count is checked."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(configure(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return query

    return register


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 9) -> DataFrame:
    """Round floating sums whose last bits depend on the order of addition; + 0.0 turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


def rounded_sql(expression: str, name: str, digits: int = 9) -> str:
    return f"round({expression}, {digits}) + 0e0 AS {name}"
