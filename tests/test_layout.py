"""Frames and videos laid out for joins without an exchange."""
import re

from pyspark.sql import functions as F

from mediafeat.session import scratch_path
from mediafeat.sources import layout as LY


def _tables(spark):
    # id 0 holds half of the frames; ids 200.. have no video, videos 180.. no frames; nulls on both sides
    frames = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).when(F.col("id") % 101 == 0, F.lit(None))
                                      .otherwise(F.col("id") % 250).cast("long").alias("id"), F.col("id").alias("step"))
    video = spark.range(200).select(F.when(F.col("id") == 7, F.lit(None)).otherwise(F.col("id")).cast("long").alias("id"),
                                    F.concat(F.lit("v"), F.col("id")).alias("name"))
    return frames, video.union(video.where("id in (0, 3)"))      # ids that repeat


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_equals_the_plain_join(spark):
    frames, video = _tables(spark)
    want = sorted(map(tuple, frames.join(video, "id").collect()))
    for hot_rows in (10, 100, 1 << 20):
        lay = LY.write_colocated(frames, video, scratch_path(spark, "lay"), buckets=4, sort=("step",), hot_rows=hot_rows)
        assert sorted(map(tuple, LY.join_colocated(spark, lay).select("id", "step", "name").collect())) == want
        assert LY.colocated_frames(spark, lay).count() == frames.count()
        LY.drop(spark, lay)


def test_buckets_meet_without_an_exchange(spark):
    frames, video = _tables(spark)
    lay = LY.write_colocated(frames, video, scratch_path(spark, "lay"), buckets=4, hot_rows=100)
    parts = [spark.table(f"{lay.name}_{t}") for t in ("frames", "video")]
    assert not re.search(r"\bExchange\b", _plan(parts[0].join(parts[1].hint("merge"), "id")))
    assert not re.search(r"\bExchange\b", _plan(parts[0].groupBy("id").count()))
    # the joined whole: exchanges only on the side of hot ids
    assert "Exchange hashpartitioning" not in _plan(LY.join_colocated(spark, lay)).split("Union")[-1].split("_hot")[0].split("Bucketed")[0]


def test_a_hot_id_is_in_no_bucket(spark):
    frames, video = _tables(spark)
    lay = LY.write_colocated(frames, video, scratch_path(spark, "lay"), buckets=4, hot_rows=100)
    sizes = [r["count"] for r in spark.table(f"{lay.name}_frames").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) < frames.count() / 2 and max(sizes) < 2 * sum(sizes) / 4 + 100
    hot = spark.read.parquet(f"{lay.path}/frames_hot")
    assert hot.where("id = 0").count() == 2000 and hot.where("id is null").count() > 0


def test_another_session_attaches_the_tables(spark):
    frames, video = _tables(spark)
    lay = LY.write_colocated(frames, video, scratch_path(spark, "lay"), buckets=4, hot_rows=100)
    want = sorted(map(tuple, LY.join_colocated(spark, lay).collect()))
    LY.drop(spark, lay)
    LY.attach(spark, lay, "id bigint, step bigint", "id bigint, name string")
    assert sorted(map(tuple, LY.join_colocated(spark, lay).collect())) == want
    empty = LY.write_colocated(frames.limit(0), video, scratch_path(spark, "lay"), buckets=2)
    assert LY.join_colocated(spark, empty).isEmpty()
