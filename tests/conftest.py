import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def make_session():
    from threadloom.session import local_session

    return local_session(8)


def pytest_configure(config):
    # column expressions at module level need a running session
    make_session()


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
