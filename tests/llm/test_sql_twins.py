"""Queries with a SQL twin, at the smallest scale."""

import pytest

from check_oracle import compare, connect
from pulseframe.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLE[name]) == ""
