"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from catalog.check import compare, oracle

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_query_has_a_name_and_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and "position" in out.columns


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert entry.queries()[name](spark, SF).count() > 0
    else:
        assert compare(spark, con, SF, entry.queries()[name], sql) is None
