"""Registry wiring query keys to Spark builders and to their DuckDB-runnable SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}

_MODULES = ("sources", "projection", "filters", "joins", "aggregation", "windows", "ordering",
            "sets", "reshape", "scalars", "resample", "stats", "plotdata", "udfs", "streams", "flows")


def register(key: str, sql: str | None = None):
    """Decorator: ``@register("key", sql=...)``; omit ``sql`` for a rows-only check."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"framewise.plans.{m}")


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(SQL)
