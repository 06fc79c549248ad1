"""Query registry: each named query has a Spark builder and (when SQL-expressible) a DuckDB oracle."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlens.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]

MODULES = ("q_explore", "q_stats", "q_quality", "q_sources", "q_store", "q_features", "q_evaluation", "q_models", "q_scoring")

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def shipped(fn: QueryFn) -> QueryFn:
    """The query, run after its package has been sent to the workers."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    return run


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = shipped(fn)
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every query module so the registry is complete."""
    import importlib

    for mod in MODULES:
        importlib.import_module(f"churnlens.plans.{mod}")
