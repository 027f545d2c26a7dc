"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame`` and their DuckDB
oracle SQL.

Every query reads the driver tables through the adapter, so its work grows with the
scale factor.  Column names equal those of the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle_adapter import ADAPTER_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the body after the shared adapter CTEs
    (``<more ctes> SELECT ...`` is written as ``, x AS (...) SELECT ...``)."""

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = "WITH " + ADAPTER_SQL + sql
        return fn

    return wrap


def _load() -> None:
    from . import q_attribution, q_boosting, q_core, q_decision, q_exports, q_governance, q_models, q_publish, q_reports, q_slices, q_trained  # noqa: F401


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def all_oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
