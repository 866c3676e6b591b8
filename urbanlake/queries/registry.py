"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, body: str, *ctes: str) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL: ``body`` after ``ctes``."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = fn
        ORACLE[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + body
        return fn

    return register
