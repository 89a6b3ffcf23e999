import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scanloom import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__sql__autoBroadcastJoinThreshold="10MB")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
