"""Every registered query against its SQL on the smallest data folder."""

import pytest

from costloom.plans import CHECKS, QUERIES
from tools.check_queries import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, con, name):
    ok, _, text = compare(spark, con, name, FOLDER)
    assert ok, text


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
