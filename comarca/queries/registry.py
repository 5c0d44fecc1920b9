"""Named queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function as a query under its own name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profile_sql(source: str, columns: dict[str, str]) -> str:
    """SQL for a profile, column by column."""
    parts = [
        f"""
        SELECT '{name}' AS "column", CAST(coalesce(sum(n), 0) AS BIGINT) AS "count",
               count(*) AS "unique",
               arg_min(value, (-n, value)) AS top, max(n) AS freq
        FROM (SELECT {expression} AS value, count(*) AS n FROM {source} GROUP BY 1)
        WHERE value IS NOT NULL
        """
        for name, expression in columns.items()
    ]
    return " UNION ALL ".join(parts)
