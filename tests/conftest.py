import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from firesight.session import local_session
    s = local_session("*", 8, app="firesight-tests")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    base = "/tmp/fs"
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(prefix="t-", dir=base)
