"""The entry module without the packages that only the corpus operators use."""

import subprocess
import sys
from pathlib import Path

import pytest

from postlark.plans.queries import QUERIES

ROOT = Path(__file__).parent.parent

BLOCKED = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["ahocorasick", "postlark.llm", "tokenizers"])
def test_core_queries_stand_alone(name):
    done = subprocess.run(
        [sys.executable, "-c", BLOCKED.format(name=name)], cwd=ROOT, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(QUERIES))] * 2
