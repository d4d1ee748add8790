import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import checkpoint_dir, local_session
    session = local_session(shuffle_partitions=8)
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fx(spark):
    from cadenza.sources.fixtures import Fixture
    return Fixture(spark, SF_SMALL)
