import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from fathom.session import build_session

    session = build_session("local[4]", 4, app_name="fathom-tests")
    yield session
    session.stop()
