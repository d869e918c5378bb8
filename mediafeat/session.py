"""Session construction and shared scratch locations.

Scratch output (round trips, ingest checkpoints, lineage cuts) always goes
under the cluster's shared ``spark.checkpoint.dir``.  Only when a session has
none (local tests) do we create one, and we register it on the session so the
rest of the job sees the same value.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from real shuffle sizes
# (broadcast only when the measured side is small), coalesces small shuffle
# partitions and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide nested feature rows: keep Arrow batches small, by rows and by bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "mediafeat",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the scale settings applied."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set a private one only where the session has none (as in unit tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - connect sessions
            root = None
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            # a machine-local folder is not shared by executors on a cluster
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="mediafeat-ckpt-")
        atexit.register(shutil.rmtree, root, True)     # private to this process
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    else:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(root)
        except Exception:  # pragma: no cover
            pass
    return root.rstrip("/")


_RUN = uuid.uuid4().hex[:12]
_MADE: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, in one folder per
    driver process that :func:`clear_scratch` removes (also at the process's end)."""
    folder = f"{checkpoint_root(spark)}/mediafeat/run-{_RUN}"
    if folder not in _MADE:
        _MADE[folder] = spark
        atexit.register(clear_scratch)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch() -> None:
    """Delete the scratch folders of this process; results that still read them are
    no longer valid."""
    for folder, spark in list(_MADE.items()):
        try:
            jvm = spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session has ended before the process
            local = local_path(folder)
            if local.startswith("/"):
                shutil.rmtree(local, ignore_errors=True)
        _MADE.pop(folder, None)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def cluster_conf(input_bytes: int, executor_cores: int = 8, executor_memory_gb: int = 32,
                 target_partition_mb: int = 256) -> dict[str, str]:
    """Settings for a cluster job reading ``input_bytes`` (pass them to the
    session builder or ``spark-submit --conf``).

    * scan splits and shuffle partitions of ~``target_partition_mb`` so a task's
      working set stays a small fraction of executor memory
      (``executor_memory_gb / executor_cores`` per core) and sorts/aggregations
      spill rarely; AQE starts from the upper bound and coalesces down to the
      advisory size from measured map output;
    * skewed join partitions (4x the median and above 1 GB) are split by AQE;
    * broadcast joins only under a measured 64 MB;
    * executor loss: decommissioning migrates shuffle and cached blocks of a
      leaving executor, tasks are retried, stages re-attempted.
    """
    per_core_mb = executor_memory_gb * 1024 // max(1, executor_cores)
    part_mb = max(32, min(target_partition_mb, per_core_mb // 4))
    parts = int(min(200_000, max(200, input_bytes // (part_mb * 1024 * 1024))))
    return {
        "spark.sql.files.maxPartitionBytes": f"{part_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{part_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        # Arrow batches to Python kernels: a row can be megabytes (T x 1024 frames),
        # so batches are capped by bytes as well as rows
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
        "spark.task.maxFailures": "8",
        "spark.stage.maxConsecutiveAttempts": "8",
    }


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``mediafeat`` importable in every Python worker of the application.

    Operators with Python kernels (record codec data source, mapInPandas
    training, Arrow UDFs) run in worker processes that do not see the driver's
    ``sys.path``.  The package is zipped once per application into the shared
    checkpoint folder (content-addressed) and registered with ``addPyFile``.
    """
    import hashlib
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in sorted(os.walk(pkg)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, base))
    data = buf.getvalue()
    path = f"{checkpoint_root(spark)}/mediafeat-py/mediafeat-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    from pyarrow import fs as pafs
    uri = path if "://" in path else ("file://" + path if path.startswith("/") else path)
    fs, p = pafs.FileSystem.from_uri(uri)
    if fs.get_file_info(p).type == pafs.FileType.NotFound:
        fs.create_dir(os.path.dirname(p), recursive=True)
        with fs.open_output_stream(p) as out:
            out.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(key)


def _mem_bytes(v: str) -> int:
    v = v.strip().lower().rstrip("b")
    mult = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(float(v[:-1]) * mult[v[-1]]) if v and v[-1] in mult else int(float(v) * (1 << 20))


def memory_per_core(spark: SparkSession) -> int:
    """Bytes of executor memory per task slot (driver memory in local mode)."""
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local")
    mem = conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g")
    cores = spark.sparkContext.defaultParallelism if local else int(conf.get("spark.executor.cores", "1"))
    return _mem_bytes(mem) // max(1, cores)
