"""Registered queries against their SQL."""

import pytest

from testbed import queries as _registered  # noqa: F401  (fills the registry)
from testbed.check import compare, connect
from testbed.registry import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    state, _, _, note = compare(spark, duck, name, QUERIES[name], SQL[name], DIR)
    assert state == "ok", note
