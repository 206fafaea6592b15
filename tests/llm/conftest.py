import pytest

from tapeloom.llm.ship import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """A table from rows of tuples and a schema; texts may hold anything."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
