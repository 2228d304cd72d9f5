import pytest

from corpusloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Applies a Column function to a list of values in one job."""

    def run(values, function, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        rows = df.select("i", function("v").alias("r")).collect()
        return [row["r"] for row in sorted(rows, key=lambda row: row["i"])]

    return run
