import pytest

from tallywire.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
