import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_spark
    s = get_spark("local[4]", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf01():
    if not os.path.exists(f"{SF01}/lineitem.parquet"):
        pytest.skip("driver tables not available")
    return SF01
