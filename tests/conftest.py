"""One local session for all tests."""

from __future__ import annotations

import pytest

from tallyloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tallyloom-tests")
    session.sparkContext.setLogLevel("OFF")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()
