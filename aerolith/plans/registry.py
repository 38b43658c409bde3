"""Query registry: one named Spark plan per operator, with its DuckDB twin.

``QUERIES[name] = (build(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
Every plan reads the driver tables (directly or through ``readings``), so its
work grows with them. Output columns carry the same aliases in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, oracle)
        return fn
    return deco


def load_all() -> dict:
    """Import every module that registers queries."""
    from aerolith.plans import catalog, q_layers, q_ml, q_serving, q_sources, q_text, q_warehouse  # noqa: F401
    return QUERIES
