"""Every registered query against its SQL, over the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    verdict, _ = compare(spark, con, SF_DIR, name, QUERIES[name], SQL.get(name))
    assert verdict in ("ok", "no SQL")


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
