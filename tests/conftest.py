from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from navstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "navstream-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.sql.streaming.stopTimeout": "30s"},
    )
    session.sparkContext.setLogLevel("ERROR")
    # Tests may name their own checkpoint folder only where the session names none.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="navstream-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return Path(tempfile.mkdtemp(prefix="navstream-test-"))
