import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session("8")


@pytest.fixture(scope="session")
def con():
    return connect(SMALL)


@pytest.fixture(scope="session")
def sf():
    return SMALL
