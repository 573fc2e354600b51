import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from gleaner.session import local_session
    from suite.adapters import ship

    session = local_session("tests", "8")
    ship(session)
    yield session
    session.stop()
