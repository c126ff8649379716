"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as registered
from compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = registered.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert ORACLE.keys() <= registered.queries().keys()


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, tables, name):
    query = registered.queries()[name]
    if name in ORACLE:
        assert compare(spark, tables, query, ORACLE[name], SF_DIR) in (None, "no rows")
    else:
        assert query(spark, SF_DIR).count() > 0
