"""Queries and their SQL twins, registered side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from testbed.sqlviews import VIEWS
from testbed.tables import Tables
from waymarks.session import tuned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables``.

    ``sql`` continues the common table expressions: it starts with ``SELECT`` or with ``, name
    AS (...)``.
    """

    def register(build: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: build(Tables(tuned(spark), sf_dir))
        if sql is not None:
            SQL[name] = f"{VIEWS}{sql}" if sql.lstrip().startswith(",") else f"{VIEWS}\n{sql}"
        return build

    return register
