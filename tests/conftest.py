import pytest

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__default__parallelism="4",
        spark__sql__warehouse__dir="/tmp/millrace-test-warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
