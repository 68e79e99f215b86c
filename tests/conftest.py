from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from airledger.session import build_session  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app="airledger-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="airledger-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="airledger-test-", dir="/tmp")
