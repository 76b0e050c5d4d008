import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventlink.session import local_session

    s = local_session("*", 8, app="eventlink-tests",
                      checkpoint_dir=tempfile.mkdtemp(prefix="eventlink-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


def rows(df, cols=None):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
