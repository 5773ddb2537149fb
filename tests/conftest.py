import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from checks.session import local_session

    session = local_session(partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    from checks.registry import Data

    return Data(spark, SF)
