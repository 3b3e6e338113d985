"""The registry of queries and of the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stepquarry.plans.runtime import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, folder) -> DataFrame, with its SQL where SQL can say it."""

    def add(f: Query) -> Query:
        n = name or f.__name__
        if n in QUERIES:
            raise ValueError(f"two queries are named {n}")
        QUERIES[n] = f
        if sql is not None:
            SQL[n] = sql
        return f

    return add


def shipped(f: Query) -> Query:
    """The query, after the package has been given to the executors."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return f(spark, folder)

    run.__name__, run.__doc__ = getattr(f, "__name__", "query"), f.__doc__
    return run
