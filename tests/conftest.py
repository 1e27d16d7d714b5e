import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, memory="8g", partitions=4)
    yield session
    session.stop()
