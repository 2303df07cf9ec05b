import pytest

from tools.session import build


@pytest.fixture(scope="session")
def spark():
    return build()
