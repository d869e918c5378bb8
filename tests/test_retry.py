"""Idempotent record writing under a task retry (subprocess: needs local[N,retries])."""
import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_retried_write_is_complete_without_duplicates():
    out = subprocess.run([sys.executable, os.path.join(HERE, "retry_probe.py")],
                         capture_output=True, text=True, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    r = json.loads(out.stdout.strip().splitlines()[-1])
    assert r["failure_injected"]
    assert r["complete"] and r["rows"] == 4000 and r["distinct"] == 4000
    assert not any(f.startswith("_tmp") for f in r["files"])
    assert "_SUCCESS" in r["files"]
