import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from stellate.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (None sorts first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
