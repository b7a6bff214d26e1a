"""Registry of named queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query ``(spark, sf_dir) -> DataFrame`` and its SQL."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def quoted(values) -> str:
    """SQL list of string literals."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def rows_of(values) -> str:
    """SQL VALUES rows of one string column."""
    return ", ".join("('" + v.replace("'", "''") + "')" for v in values)
