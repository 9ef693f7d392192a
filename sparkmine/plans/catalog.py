"""Registry of named queries: Spark builder ``(spark, sf_dir) -> DataFrame`` plus,
where one exists, the DuckDB SQL that computes the same rows (the oracle)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = (
    "relational_queries",
    "io_queries",
    "text_queries",
    "sequence_queries",
    "itemset_queries",
    "seqrule_queries",
    "kmeans_queries",
)


def register(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def load_all() -> None:
    for mod in _MODULES:
        importlib.import_module(f"sparkmine.plans.{mod}")


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
