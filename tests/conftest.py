import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lumenfold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4")
    yield session
    session.stop()


@pytest.fixture
def hot_pieces(monkeypatch):
    """Let the salted join cut keys of a few rows, as it would cut large ones."""
    from lumenfold.plans import skew

    monkeypatch.setattr(skew, "MIN_PIECE_ROWS", 3)
    monkeypatch.setattr(skew, "SHARES", 16)
    monkeypatch.setattr(skew, "broadcasts", lambda df: False)
