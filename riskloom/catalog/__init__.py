"""Registered queries, one per operator, each with the SQL that checks it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its check SQL."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    from riskloom.catalog import drift, features, ingest, metrics, models, monitoring, preprocess, streams  # noqa: F401
