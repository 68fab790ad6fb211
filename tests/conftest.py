import datetime

import pytest

from gridmill.session import build_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[*]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": "/tmp/gridmill-tests-warehouse",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def at():
    """Timestamps from short text."""
    return datetime.datetime.fromisoformat


def rows(df, *columns):
    """Sorted plain tuples of a frame."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
