import pyarrow.dataset as ds
import pytest

SF_DIR = "/root/testdata/sf0.01"


def rows_of(name, sf_dir=SF_DIR):
    return ds.dataset(f"{sf_dir}/{name}.parquet").to_table().to_pylist()


@pytest.fixture(scope="session")
def documents():
    return rows_of("documents")


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame of dealt rows over several partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
