import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapeloom.settings import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=8, memory="12g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
