import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from seedmill.session import ensure_checkpoint_dir, get_session
    s = get_session("local[4]", shuffle_partitions=4, app="seedmill-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


SF0001 = "/root/testdata/sf0.001"
