import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from flowlens import get_session
    s = get_session("local[4]", app="flowlens-tests", shuffle_partitions=8)
    # The checkpoint root comes from spark.checkpoint.dir; when the session
    # has none, flowlens registers a temporary one (flowlens.session).
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
