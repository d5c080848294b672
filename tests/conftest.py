import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hearth.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="hearth-tests", driver_memory="6g")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (nulls sort first)."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
