"""Jobs survive a failed task attempt with neither loss nor duplicates."""

import json
import os
import subprocess
import sys

SCRIPT = os.path.join(os.path.dirname(__file__), "scripts", "fault_injection.py")


def test_landing_survives_task_failure():
    res = subprocess.run([sys.executable, SCRIPT], capture_output=True, text=True, timeout=600)
    line = [ln for ln in res.stdout.splitlines() if ln.startswith("{")]
    assert line, res.stderr[-2000:]
    got = json.loads(line[-1])
    n = got["input"]
    assert got["routed"] == got["routed_distinct"] == n
    assert got["injected_failures"] >= 4  # one per job at least: the retries really happened
    assert got["landed"] == got["landed_distinct"] == n
    assert got["batch"] == got["batch_distinct"] == n
    assert got["seq_rows"] == got["seq_distinct"] == n
