import pytest

from tests.compare import connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck_sf():
    return connect(SF)
