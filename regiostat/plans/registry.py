"""Registry of named queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``oracle``
    is the DuckDB SQL over the driver's tables (omit for rows-only checks)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registry
    import importlib
    for m in MODULES:
        importlib.import_module(f"regiostat.plans.{m}")


MODULES = ["q_hierarchy", "q_recompute", "q_zonal", "q_tabular", "q_validate", "q_repos", "q_views", "q_run"]
