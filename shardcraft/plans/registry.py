"""Registry of the named queries run against the driver tables.

Each entry pairs a DataFrame builder ``fn(spark, sf_dir) -> DataFrame`` with
the equivalent SQL for DuckDB (``None`` where the operator is not expressible
in SQL; then only row counts are compared).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql)
        return fn
    return deco
