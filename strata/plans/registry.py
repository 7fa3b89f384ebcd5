"""Registry of named queries.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` plus, where the result is
SQL-expressible, an independent ANSI SQL twin that DuckDB runs over the same
parquet tables. Column names are aliased identically on both sides.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

_MODULES = (
    "strata.plans.tpch",
    "strata.plans.parsing",
    "strata.plans.flights",
    "strata.plans.listings",
    "strata.plans.dashboards",
    "strata.plans.quality",
    "strata.plans.profiling",
    "strata.plans.io",
)


def query(name: str, sql: str | None = None):
    """Decorator registering ``fn(spark, sf_dir)`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
