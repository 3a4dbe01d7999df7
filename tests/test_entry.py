"""The driver's entry module with and without the training-data subpackage."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len([q for q in entry.queries() if not q[:3].startswith(("op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9")) and q != "pipeline"]), "pipeline" in entry.queries(), set(entry.oracle_sql()) <= set(entry.queries()))
"""


@pytest.mark.parametrize("name", ["ahocorasick", "zstandard", "corpus_pipeline", "daybook.llm"])
def test_core_queries_without_the_subpackage(name):
    from daybook.plans.queries import QUERIES
    run = subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-2000:]
    assert run.stdout.split() == [str(len(QUERIES)), "False", "True"]
    there = os.path.isdir(os.path.join(REPO, "daybook", "llm"))
    assert ("left out" in run.stderr) == (there and name in ("ahocorasick", "zstandard"))
