"""Every registered query against its SQL over the same tables."""

import compare
import pytest

import __spark_entry__ as driver
from gridloom.plans import catalog

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def tables(sf_dir):
    return compare.connect(sf_dir)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, tables, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), tables, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1
