"""Joining frame-level to video-level data and checking it.

``frame_video_join`` is an inner equi-join on ``id`` (the intent the source
states; its nested loop kept unmatched frame rows by accident, Q8).  Catalyst
and AQE pick the strategy from measured sizes: broadcast when the video side
is small, sort-merge otherwise, with skewed ids split by AQE.  When frames are
first assembled per video (grouped by id), the join reuses that hash
partitioning and only the video side moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame_video_join(frames: DataFrame, video: DataFrame, id_col: str = "id",
                     dedup_video: bool = False) -> DataFrame:
    """Frames with their video-level columns; duplicate video ids multiply (Q9)
    unless ``dedup_video``."""
    if dedup_video:
        video = video.dropDuplicates([id_col])
    return frames.join(video, id_col, "inner")


def frames_with_video(frames: DataFrame, video: DataFrame, id_col: str = "id") -> DataFrame:
    """Frames whose id exists on the video side (semi-join, J5)."""
    return frames.join(video.select(id_col), id_col, "left_semi")


def frames_without_video(frames: DataFrame, video: DataFrame, id_col: str = "id") -> DataFrame:
    """Frames whose id has no video row (anti-join, J5): the unmatched report."""
    return frames.join(video.select(id_col), id_col, "left_anti")


def integrity_counts(df: DataFrame, id_col: str = "id", labels_col: str = "labels") -> DataFrame:
    """n_rows, n_ids, n_labels in one pass (A8); callers assert n_ids == n_labels."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(id_col).alias("n_ids"),
                  F.count(labels_col).alias("n_labels"))


def assert_integrity(df: DataFrame, id_col: str = "id", labels_col: str = "labels") -> None:
    r = integrity_counts(df, id_col, labels_col).first()
    if r["n_ids"] != r["n_labels"]:
        raise AssertionError(f"{r['n_ids']} rows have an id but {r['n_labels']} have labels")


def feature_label_pairs(df: DataFrame, features: str, label: str) -> DataFrame:
    """(features, label) as two named columns -- the RDD tuple, kept in the planner."""
    return df.select(F.col(features).alias("features"), F.col(label).alias("label"))


def multi_input(df: DataFrame, inputs: list[str], label: str) -> DataFrame:
    """Several named inputs plus the label, always by name."""
    return df.select(*[F.col(c) for c in inputs], F.col(label).alias("label"))
