"""Registry of the driver queries: each Spark query is declared next to the ANSI SQL
that DuckDB runs on the same tables (the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``ops`` lists the
    SURVEY operator ids it exercises; ``sql`` is the DuckDB oracle (None: not
    SQL-expressible)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPERATORS[name] = ops
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco
