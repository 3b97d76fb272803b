import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import local_session

    session = local_session("ledgerflow-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fx(spark):
    from ledgerflow.plans.fixtures import Fixtures

    return Fixtures(spark, SMALL)


@pytest.fixture(scope="session")
def small():
    return SMALL
