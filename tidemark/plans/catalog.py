"""Registry of named queries and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
driver tables. A query with an oracle is checked value for value against DuckDB;
one without is checked for rows only and has a brute-force test in ``tests/``.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_MODULES = (
    "tidemark.plans.sensor_queries",
    "tidemark.plans.bars_queries",
    "tidemark.plans.merge_queries",
    "tidemark.plans.version_queries",
    "tidemark.plans.serve_queries",
    "tidemark.plans.layout_queries",
    "tidemark.plans.check_queries",
    "tidemark.plans.guard_queries",
    "tidemark.plans.source_queries",
)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    for module in _MODULES:
        try:
            importlib.import_module(module)
        except ModuleNotFoundError as exc:
            if exc.name != module:
                raise
    return dict(QUERIES), dict(ORACLES)
