import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillwise.session import local_session

    return local_session(8, partitions=4)


@pytest.fixture(scope="session")
def store(spark):
    from tillwise.sources.star import StarStore

    return StarStore(spark, SMALL)


@pytest.fixture(scope="session")
def duck():
    from tests.compare import connect

    return connect(SMALL)
