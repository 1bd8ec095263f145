import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from meterlake.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8, app="meterlake-tests")
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
