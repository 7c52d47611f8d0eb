"""Every registered query against its check SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "repeat_order_rate" in df.columns


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, con, name):
    assert compare(spark, con, name, SF) == ""
