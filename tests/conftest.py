import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lectern.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "4", 4)
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (all by default)."""
    found = [tuple(r) for r in df.collect()]
    names = df.columns
    keys = [names.index(c) for c in order] or range(len(names))
    return sorted(found, key=lambda r: tuple((r[k] is None, r[k]) for k in keys))
