"""Queries of the training-data operators, with their SQL where it exists."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


# where this package lies: Python tasks look here too, whatever folder the driver was started in
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain scan of one of the given tables."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
