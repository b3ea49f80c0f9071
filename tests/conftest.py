import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickscope.config import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="clickscope-test-ckpt-")
    s = build_session("local[4]", 8, "clickscope-tests", {"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from clickscope.config import checkpoint_root
    return tempfile.mkdtemp(prefix="t-", dir=checkpoint_root(spark).replace("file:", ""))
