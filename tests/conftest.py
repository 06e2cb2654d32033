import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from loglane.session import build_session

    s = build_session("local[*]", 8, app_name="loglane-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="loglane-test-", dir="/tmp")


SF_SMALL = "/root/testdata/sf0.001"
