import pytest

import __spark_entry__ as driver
from newsflow.llm.queries import ORACLES, QUERIES
from tests import compare
from tests.llm.conftest import SF_DIR


def test_queries_are_registered_one_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    columns, rows = compare.spark_rows(driver.queries()[name](spark, SF_DIR))
    expected = compare.duckdb_rows(compare.connect(SF_DIR), ORACLES[name])
    assert (columns, rows) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_a_row_per_row(spark, name):
    rows = driver.queries()[name](spark, SF_DIR).count()
    table = {"op1": "pages", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    per_row = 16 if name.startswith("op12_") else 1
    assert rows == per_row * spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
