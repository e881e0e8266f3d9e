from __future__ import annotations

import os

import pytest
from compare import assert_equal, connect

import __spark_entry__ as entry
from checks import oracle
from checks.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert_equal(QUERIES[name](spark, FOLDER), duck, SQL[name])


def test_entry(spark):
    assert entry.entry(spark).count() == 15
