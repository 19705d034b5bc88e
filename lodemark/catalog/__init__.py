"""Registered queries: each runs an operator over whole tables, with the same result in plain SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("encoding", "ranking", "labeling", "evaluation", "monitoring", "tables", "modeling")


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        import_module(f"{__name__}.{module}")
    return dict(QUERIES), dict(ORACLES)
