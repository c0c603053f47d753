import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import local_session, release_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4, memory="6g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture
def setting(spark):
    """Set session settings for one test."""
    names = []

    def put(name, value):
        names.append(name)
        spark.conf.set(name, str(value))

    yield put
    for name in names:
        spark.conf.unset(name)
