import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kiln.session import get_spark
    s = get_spark("local[4]", app_name="kiln-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("driver test data not present")
    return SMALL
