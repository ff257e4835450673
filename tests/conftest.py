from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from korale.session import clear_stored, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(int(os.environ.get("TEST_CPUS", "4")), 4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    clear_stored(s)
    s.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
