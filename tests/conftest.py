import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from matchbook.session import build_session, checkpoint_dir

    s = build_session("local[4]", shuffle_partitions=4, app="matchbook-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="matchbook-test-", dir="/tmp")
