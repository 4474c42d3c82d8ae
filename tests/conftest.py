from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Warehouse and metastore files go to a scratch folder.
    os.chdir(tmp_path_factory.mktemp("session"))
    from benchloom.session import local_session

    session = local_session(8, "tests", "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    from compare import duck

    return duck()
