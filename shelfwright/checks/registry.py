"""Queries and their SQL twins, registered side by side."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` with the DuckDB query that must agree."""

    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return keep


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")
