"""Registry of named queries over the driver tables and their DuckDB oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables. The
oracle, where one exists, is SQL that DuckDB runs over the same tables
(registered as views of the same names). Column names match one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a query (and its oracle SQL, if SQL can express it)."""
    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def load_all() -> None:
    """Import every module that registers queries."""
    from sparkwright.plans import queries  # noqa: F401
