import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from reelrank.session import local_session
    s = local_session(cores="4", shuffle_partitions=4, app="reelrank-tests")
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reelrank-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="reelrank-test-")


def rows(df, *cols):
    """Sorted list of tuples (of the given columns, default all)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
