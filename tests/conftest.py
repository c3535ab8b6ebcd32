from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from faresight.session import build_session
    session = build_session(master="local[4]", shuffle_partitions=4, app_name="faresight-tests")
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="faresight-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def workdir(spark):
    """A fresh folder under the session's shared checkpoint directory."""
    from faresight.session import fresh_path
    return fresh_path(spark, "test")
