"""Collects the queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
ORACLE: dict[str, str] = {}
#: Queries whose scan runs in Python, since Spark's own cannot read what they read.
SCAN_QUERIES: dict[str, QueryFunction] = {}
SCAN_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, scan: bool = False) -> Callable[[QueryFunction], QueryFunction]:
    def register(function: QueryFunction) -> QueryFunction:
        if name in QUERIES or name in SCAN_QUERIES:
            raise ValueError(f"query registered twice: {name}")
        (SCAN_QUERIES if scan else QUERIES)[name] = function
        if sql is not None:
            (SCAN_ORACLE if scan else ORACLE)[name] = sql
        return function

    return register
