import pytest

from tests.compare import check_engine, local_spark


@pytest.fixture(scope="session")
def spark():
    return local_spark()


@pytest.fixture(scope="session")
def engine():
    return check_engine()
