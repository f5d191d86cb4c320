import pytest

from tests.compare import connect, session


@pytest.fixture(scope="session")
def spark():
    s = session()
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def duck():
    return connect("/root/testdata/sf0.001")
