import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from searchrank.session import get_session
    s = get_session(os.environ.get("TEST_MASTER", "local[4]"), app="searchrank-tests", shuffle_partitions=8,
                    driver_memory="4g")
    yield s
    s.stop()
