import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lshark.session import checkpoint_dir, get_session
    s = get_session("local[4]", shuffle_partitions=8)
    checkpoint_dir(s)        # sets a local folder only when the session names none
    yield s
    s.stop()


@pytest.fixture()
def make_inter(spark):
    """Long-form ``(u, i)`` DataFrame from ``{u: iterable of items}``."""
    def _make(sets):
        rows = [(int(u), int(i)) for u, items in sets.items() for i in set(items)]
        return spark.createDataFrame(rows, "u bigint, i bigint")
    return _make
