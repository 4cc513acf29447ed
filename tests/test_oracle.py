"""Every query against its SQL on the smallest test data."""

from __future__ import annotations

import pytest
from check_oracle import compare, connect, contract

from clickloom.registry.oracle import oracle_sql
from clickloom.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["session_count"] > 0
