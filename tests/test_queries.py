"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry_point.queries()))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) is None


def test_entry_returns_rows(spark):
    assert 0 < entry_point.entry(spark).count() <= 10


def test_oracle_names_are_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
