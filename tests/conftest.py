import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from textlab.session import build_session

    s = build_session("local[4]", 4, app="textlab-tests")
    # tests run locally: set our own checkpoint folder because none is configured
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textlab-test-ckpt-"))
    yield s
    s.stop()
