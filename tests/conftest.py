from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marquee.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    return local_session("8", 8)


@pytest.fixture(scope="session")
def tiny():
    folder = TESTDATA / "sf0.001"
    if not folder.is_dir():
        pytest.skip("test data not present")
    return str(folder)


@pytest.fixture(scope="session")
def small():
    folder = TESTDATA / "sf0.01"
    if not folder.is_dir():
        pytest.skip("test data not present")
    return str(folder)
