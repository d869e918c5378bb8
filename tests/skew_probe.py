"""Measure task balance under a hot key from Spark's event log.

A third of the `events` rows are moved onto one user id, then each operator
runs as its own job.  The event log (written to a fresh scratch folder) gives
shuffle records read per task; for every job we report the largest task's share
of all shuffle records read in the job's busiest stage.

CLI: ``python tests/skew_probe.py [sf_dir]`` -> one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def run(sf_dir: str) -> dict:
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("skew_probe")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.sql.shuffle.partitions", "16").config("spark.ui.enabled", "false")
             .config("spark.sql.adaptive.enabled", "true")
             # keep all shuffle partitions so per-task shares are visible
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.compress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from mediafeat.operators import metrics as M
    from mediafeat.operators.ordering import number_rows
    from mediafeat.operators.sequences import assemble_sequences
    from mediafeat.plans.fixtures import steps_source

    steps = steps_source(spark, sf_dir).withColumn(
        "id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")))
    total = steps.count()
    w = Window.partitionBy("id").orderBy("ts", "event_id")
    jobs = {
        "plain_row_number": lambda: steps.withColumn("rn", F.row_number().over(w)),
        "number_rows": lambda: number_rows(steps, ["id"], ["ts", "event_id"], "rn", hot_rows=total // 20, blocks=16),
        "first_steps_assembly": lambda: assemble_sequences(steps, "id", ["ts", "event_id"], "value", 10, "seq"),
        "early_stopping": lambda: M.early_stopping(
            number_rows(steps, ["id"], ["ts", "event_id"], "epoch", hot_rows=total // 20, blocks=16)
            .withColumnRenamed("value", "loss"), "id", "epoch", "loss", 3, hot_rows=total // 20, blocks=16),
    }
    for name, make in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        make().write.format("noop").mode("overwrite").save()
    spark.stop()

    # stage -> job group; per stage, shuffle records read by each task
    stage_group, reads = {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        base = os.path.basename(path)
        if base.startswith("appstatus") or base.startswith(".") or base.endswith(".crc"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    if recs:
                        reads.setdefault(ev["Stage ID"], []).append(recs)
    out = {"rows": total, "hot_share_of_rows": 1 / 3, "jobs": {}}
    for name in jobs:
        stages = [s for s, g in stage_group.items() if g == name and s in reads]
        # the job's busiest shuffle stage (most records read)
        busiest = max(stages, key=lambda s: sum(reads[s]), default=None)
        if busiest is None:
            out["jobs"][name] = None
            continue
        r = reads[busiest]
        out["jobs"][name] = {"stage": busiest, "tasks": len(r), "records": sum(r),
                             "records_per_input_row": round(sum(r) / total, 4),
                             "max_task_records": max(r), "max_task_share": round(max(r) / sum(r), 4)}
    return out


if __name__ == "__main__":
    print(json.dumps(run(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")))
