import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kiln.session import checkpoint_root, get_spark
    s = get_spark("local[4]", app="kiln-tests", shuffle_partitions=4)
    checkpoint_root(s)   # sets a private folder only when the session has none
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
