import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from paperloom.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "tests")


@pytest.fixture
def split_all(monkeypatch):
    """Treat even small keys as heavy, so that the splitting itself is exercised."""
    from paperloom.operators import joins

    monkeypatch.setattr(joins, "HEAVY_ROWS", 2)
