import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import checkpoint_dir, get_session
    s = get_session("tidewater-tests", master="local[*]", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted list of tuples (selected columns) for order-free asserts."""
    d = df.select(*cols) if cols else df
    out = [tuple(r) for r in d.collect()]
    try:
        return sorted(out, key=lambda t: tuple((x is None, x) for x in t))
    except TypeError:
        return sorted(out, key=repr)
