"""Keep CPU-heavy narrow stages as wide as the cluster.

A scan gets one task per file split; a few large single-row-group files can
leave a text tokeniser or a record encoder on a handful of tasks while the
rest of the cluster idles.  ``spread`` round-robins rows over at least
``defaultParallelism`` partitions only when the plan has fewer -- at scale
(thousands of input splits) it is a no-op and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a narrow plan (scan + projections) over ``min_partitions``
    (default: cluster parallelism) when its input is small for the cluster.

    The partition count of a scan is not a safe signal: a file with one row
    group is cut into several byte ranges of which only one holds rows.  So the
    test is the input size estimate: below ``cores x maxPartitionBytes`` the
    input is spread (a cheap shuffle of little data); above it, files come in
    many real splits and nothing is added.  Plans that already shuffle are left
    alone: their width is the shuffle's."""
    try:
        spark = df.sparkSession
        want = min_partitions or spark.sparkContext.defaultParallelism
        qe = df._jdf.queryExecution()
        if "Exchange" in qe.sparkPlan().toString():
            return df
        size = int(str(qe.optimizedPlan().stats().sizeInBytes()))
        split = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    except Exception:  # pragma: no cover - sessions without JVM access
        return df
    return df.repartition(want) if size < want * split else df


def _bytes(v: str) -> int:
    v = v.strip().lower().rstrip("b")
    mult = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(float(v[:-1]) * mult[v[-1]]) if v and v[-1] in mult else int(v)


REUSE_CHECKPOINT_BYTES = 1 << 30  # inputs from this size on are written once before multi-pass reuse


def estimated_bytes(df: DataFrame) -> int:
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover
        return 0


def reuse(df: DataFrame, source: DataFrame | None = None, threshold: int = REUSE_CHECKPOINT_BYTES) -> DataFrame:
    """``df`` will be read by several passes.  When the input it is computed
    from (``source``, default ``df``) is large, write it once to the shared
    checkpoint folder (reliable: cuts the lineage and survives executor loss);
    small inputs are cheaper to recompute than to write."""
    if estimated_bytes(source if source is not None else df) < threshold:
        return df
    from mediafeat.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
