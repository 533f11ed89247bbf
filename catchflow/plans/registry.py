"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query builder ``fn(spark, sf_dir) -> DataFrame`` and, if given, its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r9(c: Column | str, name: str | None = None) -> Column:
    """Round a double to 9 decimals (summation order differs between engines)."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.round(c, 9)
    return out.alias(name) if name else out


def r6(c: Column | str, name: str | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = F.round(c, 6)
    return out.alias(name) if name else out
