"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> tuple[dict[str, Query], dict[str, str], Callable]:
    """Queries by key, SQL by key, and the decorator that fills both."""
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}

    def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            queries[key] = fn
            if sql is not None:
                oracles[key] = sql
            return fn

        return register

    return queries, oracles, query
