"""Registry of the queries of this package and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir), with SQL where SQL can express the result."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register
