"""Registry of named queries: ``(spark, sf_dir) -> DataFrame`` plus DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
KINDS: dict[str, str] = {}


def query(name: str, sql: str | None = None, kind: str = "oracle"):
    """Register ``fn`` under ``name``; ``sql`` is the independent oracle (None = rows-only)."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        KINDS[name] = kind if sql is not None else "rows"
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib

    for mod in MODULES:
        importlib.import_module(f"strata.plans.{mod}")


MODULES = ("q_changelog", "q_relational", "q_text", "q_documents", "q_decorate", "q_metrics",
           "q_ingest", "q_sync", "q_streaming")
