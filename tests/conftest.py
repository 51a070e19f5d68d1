from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from layercake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session("tests", 8, 4, {"spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
