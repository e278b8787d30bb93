"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from suite.check import compare, connect

DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = connect(DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, DIR, name)[0].startswith("ok")


def test_entry(spark):
    assert entry_point.entry(spark).count() > 1
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
