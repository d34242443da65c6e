import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marginflow.session import get_session
    s = get_session(master="local[*]", shuffle_partitions=8,
                    extra_conf={"spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def ws_small(spark):
    from marginflow.plans.catalog import workspace
    return workspace(spark, SF_SMALL)


@pytest.fixture(scope="session")
def ws_check(spark):
    from marginflow.plans.catalog import workspace
    return workspace(spark, SF_CHECK)
