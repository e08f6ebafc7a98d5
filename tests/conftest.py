import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from inboxlens.session import build_session

    # spark.checkpoint.dir comes from the session's configuration; when it is
    # unset, scratch_root() gives this local session a fresh temporary folder
    s = build_session("local[*]", "inboxlens-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from inboxlens.session import fresh_dir
    return fresh_dir(spark, "t")
