"""Registry of named queries and their DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the driver
tables (through ``Views``) and applies library operators.  The oracle is an
independent SQL text over the same tables; queries that SQL cannot express
register without one and are checked by unit tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that its registrations run."""
    from quarry.plans import (  # noqa: F401
        q_clinical, q_learning, q_core, q_text, q_graph, q_stats, q_models, q_sampling, q_stream, q_misc,
    )
