import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def data():
    """Whole small tables, where they are given."""
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
