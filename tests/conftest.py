from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from billstar.session import get_session
    s = get_session(master="local[*]", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="billstar-test-")


def write_text(path: str, text: str) -> str:
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path
