"""The registered queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Queries that DuckDB's SQL cannot express; tests compare them with plain Python.
BEYOND_SQL: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def beyond_sql(fn: Query) -> Query:
    BEYOND_SQL[fn.__name__] = fn
    return fn
