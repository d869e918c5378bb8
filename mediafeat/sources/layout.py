"""Frame and video tables laid out for repeated joins by id.

Both tables are written bucketed and sorted by id with the same number of buckets, so a
join of them, and a grouping by id, need no exchange however often they are run.

A bucket is one task of such a join, and no later stage can split it.  So ids with more
than ``hot_rows`` frames do not go to the buckets: their frames, and the video rows that
they meet, are two plain tables joined beside it, where AQE broadcasts or splits by
measured size.  Frames without an id have no partner; they stand among the plain ones.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 1 << 20     # frames of one id from which on they are kept out of its bucket


@dataclass(frozen=True)
class Layout:
    """Where a pair of tables lies: ``name`` is the prefix of two bucketed tables of the
    session's catalog, ``path`` the folder of all four."""
    name: str
    path: str
    id_col: str
    buckets: int


def write_colocated(frames: DataFrame, video: DataFrame, path: str, id_col: str = "id", buckets: int = 64,
                    sort: tuple[str, ...] = (), hot_rows: int = HOT_ROWS, name: str | None = None) -> Layout:
    """Write ``frames`` and ``video`` under ``path`` (a shared folder); ``sort`` are further
    sort columns of frames.  Rows that repeat an id stay."""
    spark = frames.sparkSession
    name = name or f"colocated_{uuid.uuid4().hex[:12]}"
    path = path.rstrip("/")
    frames.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > hot_rows).select(id_col).write.parquet(f"{path}/hot_ids")
    hot = spark.read.parquet(f"{path}/hot_ids")
    known = frames.where(F.col(id_col).isNotNull())
    _bucketed(known.join(hot, id_col, "left_anti").select(*frames.columns), f"{name}_frames", f"{path}/frames", id_col, buckets, sort)
    _bucketed(video.where(F.col(id_col).isNotNull()).join(hot, id_col, "left_anti").select(*video.columns),
              f"{name}_video", f"{path}/video", id_col, buckets, ())
    known.join(hot, id_col, "left_semi").select(*frames.columns).union(frames.where(F.col(id_col).isNull())).write.parquet(f"{path}/frames_hot")
    video.join(hot, id_col, "left_semi").select(*video.columns).write.parquet(f"{path}/video_hot")
    return Layout(name, path, id_col, buckets)


def _bucketed(df: DataFrame, table: str, path: str, id_col: str, buckets: int, sort: tuple[str, ...]) -> None:
    # one task a bucket, so one sorted file a bucket
    (df.repartition(buckets, id_col).write.bucketBy(buckets, id_col).sortBy(id_col, *sort)
     .option("path", path).format("parquet").saveAsTable(table))


def attach(spark: SparkSession, layout: Layout, frames_schema: str, video_schema: str) -> None:
    """Name the bucketed tables of a layout that another session has written."""
    for kind, schema in (("frames", frames_schema), ("video", video_schema)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {layout.name}_{kind} ({schema}) USING parquet "
                  f"CLUSTERED BY ({layout.id_col}) SORTED BY ({layout.id_col}) INTO {layout.buckets} BUCKETS LOCATION '{layout.path}/{kind}'")


def colocated_frames(spark: SparkSession, layout: Layout) -> DataFrame:
    """All frames of the layout: those in buckets and the plain ones."""
    return spark.table(f"{layout.name}_frames").unionByName(spark.read.parquet(f"{layout.path}/frames_hot"))


def join_colocated(spark: SparkSession, layout: Layout) -> DataFrame:
    """The inner join of frames and video rows: buckets meet where they lie (no
    exchange), hot ids beside them."""
    ordinary = spark.table(f"{layout.name}_frames").join(spark.table(f"{layout.name}_video").hint("merge"), layout.id_col)
    plain = [spark.read.parquet(f"{layout.path}/{t}_hot") for t in ("frames", "video")]
    return ordinary.unionByName(plain[0].join(plain[1], layout.id_col))


def drop(spark: SparkSession, layout: Layout) -> None:
    """Forget the table names; the files under ``path`` stay."""
    for kind in ("frames", "video"):
        spark.sql(f"DROP TABLE IF EXISTS {layout.name}_{kind}")
