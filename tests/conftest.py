import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def roles(spark):
    from tallyspark.sources.roles import TestDataRoles
    return TestDataRoles(spark, SMALL)


@pytest.fixture(scope="session")
def params():
    from tallyspark.params import test_params
    return test_params()
