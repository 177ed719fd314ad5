import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marlstone.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", "4", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def day():
    return lambda text: dt.date.fromisoformat(text) if text else None
