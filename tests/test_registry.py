"""Every registered query against its SQL, on the smallest test set."""

import pytest

import __spark_entry__ as entry_point
from checks import compare
from conftest import SF_DIR


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query_agrees_with_sql(spark, connection, name):
    problem, _ = compare.difference(
        spark, connection, name, entry_point.queries()[name], entry_point.oracle_sql().get(name), SF_DIR
    )
    assert problem is None


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_sql_only_for_registered_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
