"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks.session import configure

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its name, with equivalent SQL if any."""

    def register(function: Query) -> Query:
        name = function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(configure(spark), folder)

        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return function

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, *names: str, scale: int = 2) -> DataFrame:
    """Sums of money to cents, so that the order of addition does not show."""
    return df.withColumns({n: F.round(F.col(n), scale) for n in names})
