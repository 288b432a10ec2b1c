import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tickweave.session import local_session

    s = local_session(cores="*", partitions=8, app="tickweave-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples, sorted (order-insensitive checks)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
