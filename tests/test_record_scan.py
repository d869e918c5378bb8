"""Record shards as a data source: chosen shards, fields, damage, overwritten files."""
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediafeat.session import local_path, scratch_path
from mediafeat.sources import record_scan as RS
from mediafeat.sources import records as RC

SCHEMA = "id long, x array<double>, note string"


def _written(spark, rows=400):
    path = scratch_path(spark, "scan")
    df = spark.range(rows).select("id", F.array((F.col("id") * 2).cast("double")).alias("x"),
                                  F.concat(F.lit("n"), "id").alias("note"), F.concat(F.lit("s"), F.col("id") % 4).alias("shard"))
    RC.write_records(df, path, partition_by="shard", shards=4)
    return path


def _shards(path, shard="*"):
    return sorted(glob.glob(f"{local_path(path)}/shard={shard}/*.tfrecord"))


def test_same_rows_as_the_reader_for_every_split(spark):
    path = _written(spark)
    want = sorted(map(str, RC.read_records(spark, path, SCHEMA).collect()))
    for split in (1000, 1 << 14, 128 << 20):
        assert sorted(map(str, RS.scan(spark, path, SCHEMA, split_bytes=split).collect())) == want


def test_patterns_leave_shards_unopened(spark):
    path = _written(spark)
    one = "file:" + _shards(path, "s1")[0]
    for patterns, n in ((one, 1), (f"{one}\nfile:/none", 1), ("*/shard=s2/*", len(_shards(path, "s2"))), ("*/shard=s[!12]/*", len(_shards(path, "s[03]"))),
                        ("file:/none*", 0), ("", len(_shards(path)))):
        parts = RS.RecordScanReader({"path": path, "shards": patterns}, RS.narrow(SCHEMA)).partitions()
        assert len({p for part in parts for p, _, _ in part.value}) == n
    ranges = [r for part in RS.RecordScanReader({"path": path, "splitBytes": "1000"}, RS.narrow(SCHEMA)).partitions() for r in part.value]
    assert len(ranges) == len(set(ranges)) == sum(-(-os.path.getsize(f) // 1000) for f in _shards(path))


def test_one_scan_used_twice_with_other_filters(spark):
    """Filters stay with Spark: each use of a scan has its own."""
    path = _written(spark)
    scan = RS.scan(spark, path, SCHEMA, "id")
    in_s1 = F.col("_file").contains("/shard=s1/")
    both = scan.where(in_s1 & F.col("_error").isNull()).withColumn("k", F.lit(1)).union(scan.where(~in_s1).withColumn("k", F.lit(0)))
    assert sorted((r.id, r.k) for r in both.collect()) == [(i, int(i % 4 == 1)) for i in range(400)]
    chosen = RS.scan(spark, path, SCHEMA, "id", shards=["*/shard=s0/*", "*/shard=s3/*"])
    assert sorted(r.id for r in chosen.join(scan.where(in_s1 | (F.col("id") > 300)), "id").select("id").collect()) == [
        i for i in range(301, 400) if i % 4 in (0, 3)]


def test_narrow_decodes_only_the_named_fields(spark, monkeypatch):
    path = _written(spark)
    seen = []
    real = RC.decode
    monkeypatch.setattr(RC, "decode", lambda payload, schema, *a: seen.append(schema.fieldNames()) or real(payload, schema, *a))
    r = RS.RecordScanReader({"path": path}, RS.narrow(SCHEMA, "note"))
    rows = [b for part in r.partitions() for b in r.read(part)]
    assert sum(b.num_rows for b in rows) == 400 and rows[0].schema.names == ["note", "_file", "_error"]
    assert seen and all(s == ["note"] for s in seen)
    with pytest.raises(ValueError):
        RS.narrow(SCHEMA, "no_such")


def test_damage_is_reported_or_fails(spark):
    path = _written(spark)
    name = _shards(path, "s0")[0]
    data = open(name, "rb").read()
    open(name, "wb").write(data[:-3])
    all_ = RS.scan(spark, path, SCHEMA)
    want = sorted(map(str, RC.read_records(spark, path, SCHEMA).collect()))
    assert sorted(map(str, all_.collect())) == want
    assert all_.where("_error is null").count() == 399
    bad = all_.where("_error is not null").collect()
    assert len(bad) == 1 and bad[0]._file == "file:" + name and bad[0].id is None
    assert sorted(map(str, RS.scan(spark, path, SCHEMA, records="bad").collect())) == sorted(map(str, bad))
    assert RS.scan(spark, path, SCHEMA, records="good").count() == 399
    strict = spark.read.format(RS.FORMAT).schema("id long").load(path)
    with pytest.raises(Exception, match="_error in the schema"):
        strict.collect()


def test_only_shards_in_force_count(spark):
    path = scratch_path(spark, "scan")
    df = spark.range(10).select("id")
    RC.write_records(df, path)
    RC.write_records(df.where("id < 4"), path, mode="overwrite")
    RC.write_records(df.where("id = 9"), path, mode="append")
    assert sorted(r.id for r in RS.scan(spark, path, "id long").collect()) == [0, 1, 2, 3, 9]
    stray = os.path.join(local_path(path), "part-00000-000-0aaaaaaaa-w0123456789abd0.tfrecord")
    open(stray, "wb").write(open(_any(path), "rb").read())        # as a failed attempt leaves it
    assert RS.scan(spark, path, "id long").count() == 5


def _any(path):
    return sorted(glob.glob(f"{local_path(path)}/*.tfrecord"))[0]


def test_schema_without_nulls_and_missing_path(spark):
    path = _written(spark, 8)
    strict = T.StructType([T.StructField("id", T.LongType(), False)])
    assert RS.scan(spark, path, strict).count() == 8
    with pytest.raises(Exception):
        RS.scan(spark, path + "-none", SCHEMA).collect()
