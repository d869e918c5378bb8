"""The flagship plan: frame steps -> fixed-length sequences -> join video side ->
multi-hot labels = the training table (entry B of the source, as one plan).

    steps (events) --first T per id (WindowGroupLimit)--> seq
                   --count + distinct props.k per id (one partial agg)--> n_steps, labels
    seq ⋈ labels ⋈ video side (inner on id, J1) -> pad to T (Q10)
    vocabulary fitted once on the joined table (<= K-1 labels) -> multi-hot (F2)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediafeat.defaults import LABEL_SLOTS, SEQUENCE_STEPS
from mediafeat.operators.assemble import frame_video_join
from mediafeat.operators.labels import encode_labels, fit_label_vocab
from mediafeat.operators.sequences import assemble_sequences, fix_length
from mediafeat.plans.fixtures import fx_video_side, steps_source

T_STEPS = SEQUENCE_STEPS
K_LABELS = LABEL_SLOTS


def step_vector(props: str = "props", value: str = "value"):
    """Per-step feature vector: [value, k] with k read from the JSON props."""
    return F.array(F.col(value).cast("double"), F.get_json_object(props, "$.k").cast("double"))


def video_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, n_steps, labels: true length and label set in ONE partial aggregate."""
    steps = steps_source(spark, sf_dir)
    return steps.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.array_sort(F.collect_set(F.get_json_object("props", "$.k").cast("bigint"))).alias("labels"))


def frame_sequences(spark: SparkSession, sf_dir: str, t: int = T_STEPS) -> DataFrame:
    """id, seq array<array<double>> (first t steps), n_steps, labels array<bigint>."""
    steps = steps_source(spark, sf_dir)
    seq = assemble_sequences(steps, "id", ["ts", "event_id"], step_vector(), t, "frames", with_length=False)
    return seq.join(video_stats(spark, sf_dir), "id")


def training_table(spark: SparkSession, sf_dir: str, t: int = T_STEPS, k: int = K_LABELS,
                   short: str = "pad") -> DataFrame:
    """id, name, n_steps, true_len, frames (t x 2, zero padded), labels, labels_hot (k)."""
    side = fx_video_side(spark, sf_dir)
    seq = frame_sequences(spark, sf_dir, t)
    joined = frame_video_join(seq, side, "id")
    fixed = fix_length(joined, "frames", t, short=short, zero=F.array(F.lit(0.0), F.lit(0.0)))
    if short == "drop":
        vocab = fit_label_vocab(fixed, k, order="id")
    else:
        # the per-video aggregate has exactly the ids of the sequences, so the fit
        # pass joins it with the video side and never re-runs the frames' window
        vocab = fit_label_vocab(frame_video_join(video_stats(spark, sf_dir), side.select("id"), "id"), k, order="id")
    return encode_labels(fixed, vocab, k, "labels", "labels_hot")
