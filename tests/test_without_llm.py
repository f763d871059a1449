"""The library and the driver's entry in checkouts that lack the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as e
from quillrank.plans.registry import QUERIES
names, sql = set(e.queries()), set(e.oracle_sql())
assert sql <= names and set(QUERIES) <= names
print(len(QUERIES), len(names))
"""


@pytest.mark.parametrize("left_out", [("quillrank/llm",), ("quillrank/llm", "corpus_pipeline.py")])
def test_entry_imports_without(tmp_path, left_out):
    """Whatever of the optional parts is missing, every other query is there."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(d, n), ROOT) in (*left_out, "tests")])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(copy)}
    out = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    own, names = map(int, out.stdout.split())
    assert own == names >= 41
