import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from jobledger.session import checkpoint_dir, get_session

    s = get_session(master="local[4]", shuffle_partitions=4)
    checkpoint_dir(s)  # a private folder only because the session names none
    yield s
    s.stop()
