"""Registry of named queries (Spark DataFrame builders) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is an independent SQL formulation DuckDB runs on the same
    Parquet tables; omitted only for operators SQL cannot express.
    """

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that its ``register`` calls run."""
    from tessera.plans import (  # noqa: F401
        q_activity,
        q_corrections,
        q_cumulative,
        q_distincts,
        q_facts,
        q_graph,
        q_quality,
        q_scd,
        q_writers,
    )
