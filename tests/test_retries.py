"""Numbering survives task retries (run in a separate JVM that allows retries)."""

import os
import subprocess
import sys

SCRIPT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts", "retry_check.py")


def test_numbering_is_stable_under_task_retries():
    res = subprocess.run([sys.executable, SCRIPT], capture_output=True, text=True, timeout=600)
    assert "RETRY_CHECK_OK" in res.stdout, res.stdout[-2000:] + res.stderr[-4000:]
