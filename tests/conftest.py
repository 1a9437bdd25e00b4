import pytest

from revtide import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
