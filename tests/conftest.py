import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gridloom.session import local_session

    s = local_session("*", shuffle_partitions=8, app="gridloom-tests")
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
