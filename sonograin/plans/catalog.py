"""Registry of the core queries and the SQL that says the same: name -> (function, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with its SQL if SQL can express it."""
    def put(f):
        n = name or f.__name__
        if n in QUERIES:
            raise ValueError(f"{n} is registered twice")
        QUERIES[n] = f
        if sql is not None:
            ORACLES[n] = sql
        return f
    return put
