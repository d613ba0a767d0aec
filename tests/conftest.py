import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from folioflow.session import local_session

    session = local_session(4, 4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
