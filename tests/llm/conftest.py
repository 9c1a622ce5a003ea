import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """frame(rows, schema): a DataFrame over two partitions."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(2)

    return make
