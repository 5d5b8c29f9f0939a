import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A table from rows and a schema string."""

    def build(rows, schema, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return build
