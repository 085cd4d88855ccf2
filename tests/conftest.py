import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tools.local import local_session

    s = local_session(cores=8, shuffle_partitions=8, app="vhist-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted tuples of the given columns (all columns if none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_none_first)


def _none_first(t):
    return tuple((v is not None, v) for v in t)
