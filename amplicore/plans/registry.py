"""Named queries over the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (spark, sf_dir) under a name; without sql only its rows can be checked."""

    def put(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return put
