import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import build_session
    s = build_session("local[4]", app="daybook-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` (default: all) as plain tuples, sorted with nulls first."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
