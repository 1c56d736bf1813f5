import pytest

from foldwright.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "foldwright-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def no_auto_broadcast(spark):
    """Only hinted tables are broadcast, so the shuffle joins run on small data too."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df, *cols):
    """Rows as sorted tuples."""
    chosen = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda t: [(v is None, str(type(v)), v or 0) for v in t])


@pytest.fixture(scope="session")
def toy(spark):
    """The categorical toy: train and test with a missing and an unknown category."""
    train = ["mao", "rena", None, "mao", "rena", "mao", "ririmu"]
    test = ["mao", "ririmu", None, "rena", "ange"]
    schema = "row_id long, cat string"
    return (
        spark.createDataFrame(list(enumerate(train)), schema),
        spark.createDataFrame(list(enumerate(test)), schema),
    )


@pytest.fixture(scope="session")
def te_toy(spark):
    data = [
        (0, "a", 0, 1.0), (1, "a", 0, 2.0), (2, "a", 1, 6.0), (3, "b", 0, 4.0),
        (4, "b", 1, 8.0), (5, None, 1, 3.0), (6, None, 0, 5.0), (7, "c", 1, 7.0),
    ]
    return spark.createDataFrame(data, "row_id long, cat string, fold int, y double")
