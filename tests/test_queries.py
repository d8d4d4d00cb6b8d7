"""Every query that SQL can express gives the rows that DuckDB gives on the same tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
import oracle

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    got = oracle.spark_rows(driver.queries()[name](spark, SF_DIR))
    assert got == oracle.sql_rows(db, driver.oracle_sql()[name])


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_runs(spark):
    assert driver.entry(spark).columns[0] == "Model_version"
