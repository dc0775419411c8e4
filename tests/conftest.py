from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from wearline.operators import ordering, quantiles  # noqa: E402
from wearline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "wearline-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def small_limits(monkeypatch):
    """Make every size check fail, so that the ways for very large groups run."""
    monkeypatch.setattr(ordering, "BOUNDED_ROWS", 5)
    monkeypatch.setattr(ordering, "BLOCK_ROWS", 40)
    monkeypatch.setattr(quantiles, "BOUNDED_VALUES", 5)
    monkeypatch.setattr(quantiles, "SKETCH_FROM", 5)
