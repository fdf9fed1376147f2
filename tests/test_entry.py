import os

import pytest

import __spark_entry__ as driver
from tests.oracle import database, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_contract(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, name):
    df = driver.queries()[name](spark, FOLDER)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, database(FOLDER), sql) is None
