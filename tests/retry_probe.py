"""Task failure in the middle of a record write: the retried task must leave a
complete shard, no temporary leftovers and no duplicate records.

Runs its own session (``local[4,3]`` allows task retries).  CLI prints JSON.
"""

from __future__ import annotations

import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def run() -> dict:
    from pyspark.sql import SparkSession
    from pyspark.sql import types as T

    spark = (SparkSession.builder.master("local[4,3]").appName("retry_probe")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.execution.arrow.maxRecordsPerBatch", "100").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from mediafeat.session import local_path, scratch_path, ship_package
    from mediafeat.sources import records as RC
    ship_package(spark)

    marker = local_path(scratch_path(spark, "retry_marker"))
    os.makedirs(os.path.dirname(marker), exist_ok=True)      # a task may be there before the writer

    def flaky(it):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        for i, pdf in enumerate(it):
            yield pdf
            if ctx.partitionId() == 1 and ctx.attemptNumber() == 0 and i == 2:
                open(marker, "w").close()
                raise RuntimeError("injected failure after a partial write")

    df = spark.range(0, 4000, numPartitions=4).mapInPandas(flaky, "id long")
    path = scratch_path(spark, "retry")
    RC.write_records(df, path)
    files = sorted(os.listdir(local_path(path)))
    back = RC.read_records(spark, path, T.StructType([T.StructField("id", T.LongType())]))
    rows = [r["id"] for r in back.collect()]
    spark.stop()
    return {"failure_injected": os.path.exists(marker), "files": files, "rows": len(rows),
            "distinct": len(set(rows)), "complete": sorted(rows) == list(range(4000))}


if __name__ == "__main__":
    print(json.dumps(run()))
