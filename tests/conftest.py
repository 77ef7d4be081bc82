import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tracewright.session import get_session

    return get_session("local[8]", "8g", 8)
