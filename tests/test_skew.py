"""Task balance with a hot key, measured from Spark's event log (subprocess:
the probe needs its own JVM with event logging on)."""
import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_hot_key_is_spread():
    out = subprocess.run([sys.executable, os.path.join(HERE, "skew_probe.py"), "/root/testdata/sf0.01"],
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    jobs = json.loads(out.stdout.strip().splitlines()[-1])["jobs"]
    # the plain window puts the hot id (a third of the rows) in one task
    assert jobs["plain_row_number"]["max_task_share"] > 0.3
    # the skew-safe forms spread it
    assert jobs["number_rows"]["max_task_share"] < 0.2
    assert jobs["early_stopping"]["max_task_share"] < 0.2
    # first-T assembly trims before the shuffle
    assert jobs["first_steps_assembly"]["records_per_input_row"] < 0.5
