import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import session

    return session("tests", 8, "4g")


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
