import pytest

from orograd.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, app="tests")


@pytest.fixture
def one(spark):
    """Evaluate a column on a one-row table."""
    def run(col, **values):
        from pyspark.sql import functions as F
        df = spark.range(1).select(*[F.lit(x).alias(k) for k, x in values.items()])
        return df.select(col.alias("v")).first()["v"]
    return run
