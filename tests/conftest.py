import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import local_session
    s = local_session("*", shuffle_partitions=8, app="shelfwise-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A new scratch folder per test (never reused, never removed by the tests)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
