"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(D)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    fn, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert fn(spark, D).count() > 0
    else:
        assert compare(spark, con, fn, sql, D) is None


def test_entry(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
