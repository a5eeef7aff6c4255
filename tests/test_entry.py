import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHECK = """
import sys
sys.modules[sys.argv[1]] = None  # an import of it fails
import __spark_entry__ as entry
names = set(entry.queries())
assert {"t3_flatten_star", "t10_load_latest", "s1_observation_scan"} <= names
assert not any(n.startswith("op") for n in names) and "pipeline" not in names
assert set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("missing", ["zstandard", "xxhash", "cubestar.llm"])
def test_entry_without_a_library(missing):
    """The core queries stay when the optional part can't be imported."""
    done = subprocess.run([sys.executable, "-c", CHECK, missing], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
