import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from plotwise.session import local_session

    return local_session(4, partitions=4, memory="4g")


@pytest.fixture(scope="session")
def root():
    return "/root/testdata/sf0.001"
