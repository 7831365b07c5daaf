import pytest

import __spark_entry__ as driver
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    """All but the queries of the optional package, which has tests of its own."""
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(driver.queries()) - set(driver.oracle_sql()) <= set(driver.LLM_QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_its_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None
