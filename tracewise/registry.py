"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, keyed ``<id>_<slug>``.  Each reads the driver's
tables through the bindings, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle over the same tables
    (omitted for operators that SQL cannot express)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # importing the modules fills QUERIES
    from tracewise.plans import queries_service  # noqa: F401
    for mod in ("queries_mesh", "queries_graph", "queries_edge", "queries_models", "queries_io",
                "queries_tables", "queries_planted"):
        try:
            __import__(f"tracewise.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"tracewise.plans.{mod}":
                raise
    return dict(QUERIES)


def load_oracles() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
