import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    shared = tempfile.mkdtemp(prefix="tidemark-test-")
    s = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g", spark__checkpoint__dir=shared)
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL
