"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from compare import compare, connect
from conftest import FOLDER
from loanloom.catalog import all_queries
from loanloom.oracles import all_statements

QUERIES, SQL = all_queries(), all_statements()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_driver_registers_them_all():
    assert set(QUERIES) <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.slow
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, SQL[name]) == ""


def test_entry(spark):
    assert driver.entry(spark).count() > 0
