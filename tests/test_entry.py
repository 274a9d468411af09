"""The entry module without the training-data subpackage, or without a library that it needs."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from citymarts.plans.catalog import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("blocked", ["citymarts.llm", "tokenizers", "zstandard", "corpus_pipeline"])
def test_core_queries_are_there_whatever_is_missing(blocked):
    code = f"""
import sys, warnings
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {blocked!r} or name.startswith({blocked!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Block())
warnings.simplefilter("ignore")
import __spark_entry__ as e
print(len(set(e.queries()) & set(e.oracle_sql())), "pipeline" in e.queries())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    n, pipeline = out.stdout.split()
    assert int(n) >= len(QUERIES) and pipeline == "False"
