import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cartpulse.session import build_session, checkpoint_root
    s = build_session(master="local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # sets a private folder only when the session has none
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    import uuid

    from cartpulse.session import work_path
    return work_path(spark, "tests", uuid.uuid4().hex)
