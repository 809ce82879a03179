"""Where query modules register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` and the SQL that must give the same rows."""
    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn
    return register
