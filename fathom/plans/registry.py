"""Registry of named queries: each is a function (spark, sf_dir) ->
DataFrame over the driver tables, with an equivalent DuckDB SQL text when
SQL can express it exactly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
OPERATORS: dict[str, tuple[str, ...]] = {}


def query(name: str, operators: tuple[str, ...] | list[str] = (), sql: str | None = None):
    """Decorator: register ``fn`` under ``name`` (with its oracle SQL)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPERATORS[name] = tuple(operators)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco
