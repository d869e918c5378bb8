"""Scaling table: the headline plans at 1, 2, 4 and 8 cores, like the source's
published node-count table.  Each core count is a fresh JVM (``bench.py`` with
``BENCH_CPUS``); speed-up and efficiency are computed with the repository's own
W1/W2 operators.  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 python scaling.py
"""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.abspath(__file__))
QUERIES = ["video_train_eval", "training_table", "shard_conversion", "geo_new_businesses", "tokenize_words"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = [int(c) for c in os.environ.get("SCALING_CORES", "1,2,4,8").split(",")]
    rows = []
    for c in cores:
        env = dict(os.environ, BENCH_CPUS=str(c), BENCH_SF_DIR=sf_dir)
        out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), *QUERIES], env=env,
                             capture_output=True, text=True, timeout=3600)
        res = json.loads(out.stdout.strip().splitlines()[-1])
        for q, sec in res["queries"].items():
            rows.append((q, c, float(sec)))
    sys.path.insert(0, ROOT)
    from mediafeat.operators import metrics as M
    from mediafeat.session import get_session
    spark = get_session(master="local[2]")
    df = spark.createDataFrame(rows, "query string, cores int, seconds double")
    table = M.efficiency(M.speedup(df, "query", ["cores"], "seconds"), "speedup", "cores")
    result = {}
    for r in table.orderBy("query", "cores").collect():
        result.setdefault(r["query"], []).append(
            {"cores": r["cores"], "sec": round(r["seconds"], 3), "speedup": round(r["speedup"], 2),
             "efficiency": round(r["efficiency"], 2)})
    print(json.dumps({"sf_dir": sf_dir, "scaling": result}))


if __name__ == "__main__":
    main()
