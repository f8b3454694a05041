"""Every named query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as driver
from compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(driver.all_queries()))
def test_query(spark, duck, name):
    assert differences(driver.queries()[name](spark, SF), duck, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
