import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session, shared_root

    s = get_session("local[4]", shuffle_partitions=8, app_name="strata-tests")
    shared_root(s)  # tests set their own checkpoint folder only because none is configured
    yield s


@pytest.fixture()
def scratch(spark):
    from strata.session import scratch_path

    return lambda name: scratch_path(spark, name)
