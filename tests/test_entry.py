"""The entry without the optional operators, or without a module that they need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
for name in {blocked}:
    sys.modules[name] = None  # importing it fails
import __spark_entry__ as e
print(sorted(e.queries()), sorted(e.oracle_sql()))
"""


@pytest.mark.parametrize("blocked", [["xxhash"], ["sentencepiece", "slipflow.llm"], ["slipflow.llm"], ["corpus_pipeline"]])
def test_entry_without(blocked):
    out = subprocess.run([sys.executable, "-c", CODE.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True,
                         timeout=120, env=os.environ | {"PYTHONPATH": ROOT})
    assert out.returncode == 0, out.stderr[-500:]
    from slipflow.plans.catalog import QUERIES
    assert all(repr(name) in out.stdout for name in QUERIES)
    assert "'pipeline'" not in out.stdout
    if blocked != ["corpus_pipeline"]:
        assert "op4_" not in out.stdout
