import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediafeat.operators import assemble as A
from mediafeat.operators import geo as G
from mediafeat.operators import split as P
from mediafeat.session import local_path, scratch_path
from mediafeat.sources import records as RC
from mediafeat.sources import tables as TB


def test_record_aliases_roundtrip(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("seq", T.ArrayType(T.ArrayType(T.FloatType())))])
    df = spark.createDataFrame([("a", [[1.0, 2.0], [3.0, 4.0]]), ("b", [])], schema)
    p1, p2 = scratch_path(spark, "t_alias_ex"), scratch_path(spark, "t_alias_seq")
    RC.write_examples(df.select("id"), p1)
    assert sorted(r["id"] for r in RC.read_good(RC.read_examples(spark, p1, T.StructType([schema["id"]]))).collect()) == ["a", "b"]
    RC.write_sequence_examples(df, p2)
    back = {r["id"]: r["seq"] for r in RC.read_good(RC.read_sequence_examples(spark, p2, schema)).collect()}
    assert back["a"] == [[1.0, 2.0], [3.0, 4.0]]


def test_read_words_from_text_files(spark):
    path = scratch_path(spark, "t_words")
    os.makedirs(local_path(path))
    with open(os.path.join(local_path(path), "a.txt"), "w") as fh:
        fh.write("one  two\tthree\n\nfour five \n")
    words = sorted(r["word"] for r in TB.read_words(spark, path).collect())
    assert words == sorted("one two three four five".split())


def test_integrity_and_semi_join(spark):
    ok = spark.createDataFrame([(1, [1]), (2, [2])], "id long, labels array<long>")
    A.assert_integrity(ok)
    bad = spark.createDataFrame([(1, [1]), (2, None)], "id long, labels array<long>")
    with pytest.raises(AssertionError):
        A.assert_integrity(bad)
    frames = spark.createDataFrame([(1, 0), (1, 1), (3, 0)], "id long, step int")
    video = spark.createDataFrame([(1, "a")], "id long, name string")
    assert A.frames_with_video(frames, video).count() == 2
    assert A.frames_without_video(frames, video).count() == 1


def test_shard_and_radius_aliases(spark):
    df = spark.range(30).select("id", F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("shard"))
    assert P.exclude_shards(df, ["s0"]).count() == 20
    assert P.limit_shards(df, 2).select("shard").distinct().count() == 2
    assert P.limit_per_shard(df, 4, ["id"]).count() == 12
    pl = spark.createDataFrame([(1, 10.0, 10.0)], "id long, lat double, lng double")
    pt = spark.createDataFrame([(1, 10.0, 10.001), (2, 11.0, 11.0)], "bid long, lat double, lng double")
    assert G.radius_join(pl, pt, 500.0, out_col="n").first()["n"] == 1


def test_readers_take_ddl_schema(spark):
    path = scratch_path(spark, "t_ddl")
    RC.write_records(spark.range(5).select("id", F.array(F.col("id").cast("float")).alias("v")), path)
    ddl = "id bigint, v array<float>"
    a = sorted(tuple(r)[:2] for r in RC.read_good(RC.read_records(spark, path, ddl)).collect())
    b = sorted(tuple(r)[:2] for r in RC.read_good(RC.read_records_split(spark, path, ddl)).collect())
    assert a == b == [(i, [float(i)]) for i in range(5)]
