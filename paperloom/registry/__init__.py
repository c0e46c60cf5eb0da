"""Named queries over the test tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the SQL giving the same rows."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return add


def load() -> None:
    """Fill the registry."""
    from paperloom.registry import (  # noqa: F401
        filters,
        lookups,
        manifests,
        projections,
        sampling,
        storage,
        streams,
        summaries,
        validation,
    )
