import pytest

from quillmark.runtime import session, ship


@pytest.fixture(scope="session")
def spark():
    s = session("4", 4)
    ship(s)
    yield s


DATA = "/root/testdata/sf0.001"
