import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from dimkiln.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="dimkiln-tests", extra={
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="dimkiln-test-wh-", dir="/tmp")})
    # tests only: no shared checkpoint folder is configured here
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dimkiln-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="dimkiln-test-", dir="/tmp")
