import os

import pytest

import __spark_entry__ as driver
from newsflow.plans.oracles import ORACLES
from newsflow.plans.queries import QUERIES
from tests import compare

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = compare.duckdb_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    different = [(a, b) for a, b in zip(rows, expected) if a != b]
    assert not different, f"{len(different)} rows differ, first: {different[0]}"


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
