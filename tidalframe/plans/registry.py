"""Registered queries and, where plain SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return add
