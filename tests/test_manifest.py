"""Writes that become visible by one manifest, and shards that arrive by byte ranges."""
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediafeat.session import local_path, scratch_path
from mediafeat.sources import records as RC
from mediafeat.streaming.ingest import ingest_records_once

IDS = "id long"


def ids(spark, path):
    return sorted(r.id for r in RC.read_records(spark, path, IDS).collect())


def data_files(path):
    return {f for _, _, names in os.walk(local_path(path)) for f in names if f.endswith(".tfrecord")}


def put_unpublished(spark, rows, path, name):
    """A write to ``path`` that stopped before its manifest; its files and their sizes."""
    other = scratch_path(spark, name)
    RC.write_records(rows, other)
    out = []
    os.makedirs(local_path(path), exist_ok=True)
    for f in data_files(other):
        shutil.copy(f"{local_path(other)}/{f}", f"{local_path(path)}/{f}")
        out.append((f, os.path.getsize(f"{local_path(path)}/{f}")))
    return out


@pytest.mark.parametrize("replace", [True, False])
def test_a_write_counts_from_its_manifest_on(spark, replace):
    path = scratch_path(spark, "t_switch")
    RC.write_records(spark.range(10), path)
    old = data_files(path)
    new = put_unpublished(spark, spark.range(100, 105), path, "t_switch_new")
    assert ids(spark, path) == list(range(10))                       # stopped before the switch: the old state
    fs, root = RC._fs(path)
    RC.publish(fs, root, "0123456789ab", new, replace)
    want = list(range(100, 105)) if replace else [*range(10), *range(100, 105)]
    assert ids(spark, path) == want and old < data_files(path)       # stopped after it: the new one
    assert RC.vacuum(path) == (len(old) if replace else 0)
    assert ids(spark, path) == want and (old <= data_files(path)) != replace


def test_a_manifest_cut_short_does_not_count(spark):
    path = scratch_path(spark, "t_short")
    RC.write_records(spark.range(10), path)
    with open(f"{local_path(path)}/{RC.MANIFEST}/00000009-000000000000.json", "w") as f:
        f.write('{"number": 9, "replace": tr')
    assert ids(spark, path) == list(range(10))
    RC.write_records(spark.range(3), path, mode="append")
    assert ids(spark, path) == sorted([*range(10), *range(3)])


def test_foreign_shards_are_read_and_can_be_overwritten(spark):
    path = scratch_path(spark, "t_foreign")
    os.makedirs(f"{local_path(path)}/sub")
    schema = T.StructType.fromDDL(IDS)
    for name, i in (("a.tfrecord", 1), ("sub/b.tfrecord", 2)):
        with open(f"{local_path(path)}/{name}", "wb") as f:
            f.write(RC.frame(RC.encode([(i,)], schema, "Example", set())))
    assert ids(spark, path) == [1, 2]
    RC.write_records(spark.range(5, 7), path, mode="append")
    assert ids(spark, path) == [1, 2, 5, 6]
    fs, root = RC._fs(path)
    RC.publish(fs, root, "0123456789ab", put_unpublished(spark, spark.range(8, 9), path, "t_foreign_new"), True)
    assert ids(spark, path) == [8] and os.path.exists(f"{local_path(path)}/a.tfrecord")
    RC.vacuum(path)
    assert ids(spark, path) == [8] and not os.path.exists(f"{local_path(path)}/sub/b.tfrecord")


def test_partitioned_overwrites_and_appends(spark):
    path = scratch_path(spark, "t_switch_part")
    df = spark.range(60).select("id", F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("shard"))
    RC.write_records(df, path, shards=2, partition_by="shard")
    RC.write_records(df.where("id < 9"), path, shards=2, partition_by="shard")
    RC.write_records(df.where("id > 50"), path, mode="append", partition_by="shard", plain_names=True)
    assert ids(spark, path) == [*range(9), *range(51, 60)]
    assert ids(spark, f"{path}/shard=s1") == [1, 4, 7]
    manifest = sorted(os.listdir(f"{local_path(path)}/{RC.MANIFEST}"))
    assert len(manifest) == 2 and all(json.load(open(f"{local_path(path)}/{RC.MANIFEST}/{m}"))["files"] for m in manifest)


def test_bad_records_with_a_schema_that_allows_no_null(spark):
    path = scratch_path(spark, "t_not_null")
    df = spark.range(40).select("id", F.array(F.col("id")).alias("v"))
    strict = df.schema
    assert not strict["id"].nullable
    RC.write_records(df.repartition(3), path)
    RC.damage_shards(local_path(path))
    back = RC.read_records(spark, path, strict).collect()
    assert sum(r._error is None for r in back) == 38 and sum(r._error is not None for r in back) == 2


def test_a_large_shard_arrives_in_ranges_and_once(spark):
    base = scratch_path(spark, "t_ranges")
    df = spark.range(3000).select("id", F.array(*[F.col("id").cast("float")] * 20).alias("v"))
    RC.write_records(df.where("id < 2000").coalesce(1), f"{base}/landing/a")
    schema = T.StructType.fromDDL("id long, v array<float>")

    def run():
        from mediafeat.streaming.ingest import run_available
        stream = RC.read_records_stream(spark, f"{base}/landing/*", schema, split_bytes=20_000)
        assert "content" not in stream.columns
        return run_available(stream.withColumn("task", F.spark_partition_id()), f"{base}/sink", f"{base}/ckpt")
    assert run() == 1 and run() == 0
    rows = spark.read.parquet(f"{base}/sink")
    assert rows.count() == 2000 == rows.select("id").distinct().count()
    assert rows.select("task").distinct().count() > 1                # one file, several tasks
    RC.write_records(df.where("id >= 2000").coalesce(1), f"{base}/landing/b")
    assert run() == 1
    rows = spark.read.parquet(f"{base}/sink")
    assert rows.count() == 3000 == rows.select("id").distinct().count() and rows.where("_error is not null").count() == 0


def test_a_stream_waits_for_the_manifest_and_takes_foreign_shards(spark):
    base = scratch_path(spark, "t_stream_switch")
    args = (spark, f"{base}/landing/*", T.StructType.fromDDL(IDS), f"{base}/sink", f"{base}/ckpt")
    RC.write_records(spark.range(5), f"{base}/landing/a")
    new = put_unpublished(spark, spark.range(10, 13), f"{base}/landing/a", "t_stream_new")
    with open(f"{local_path(base)}/landing/a/own.tfrecord", "wb") as f:
        f.write(RC.frame(RC.encode([(77,)], args[2], "Example", set())))
    ingest_records_once(*args)
    got = lambda: sorted(r.id for r in spark.read.parquet(f"{base}/sink").collect())
    assert got() == [0, 1, 2, 3, 4, 77]
    fs, root = RC._fs(f"{base}/landing/a")
    RC.publish(fs, root, "0123456789ab", new, False)
    ingest_records_once(*args)
    assert got() == [0, 1, 2, 3, 4, 10, 11, 12, 77]
