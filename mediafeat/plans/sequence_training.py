"""Sequence-model training with validation (entry C of the source, re-aimed).

The source trains on one machine: it limits itself to a few shards and videos,
splits positionally, truncates sequences, and fits with validation data, early
stopping on the validation loss (patience 3) and a checkpoint that keeps only
the best epoch.  Here the same steps are DataFrame operators and the fit is the
data-parallel one, with the validation pass of every epoch on the executors:

    training rows (frames, labels_hot[, shard])
      -- optional shard limits (S13, S14)
      -- exact seeded split (T3)
      -- sequence pooling (M3) [+ video-level vectors, F9], standardised with
         statistics of the train rows only (M7)
      -- fit with per-epoch validation, early stopping, best weights (M1, M6, W3, W4)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediafeat.defaults import EARLY_STOP_PATIENCE, VALIDATION_RATIO
from mediafeat.operators.sequences import pool_sequence
from mediafeat.operators.split import limit_per_group, limit_values, split_holdout
from mediafeat.operators.train import LinearModel, feature_stats, fit_multilabel, standardise
from mediafeat.session import checkpoint_root

POOLS = ("mean", "max", "first", "last", "fwd", "bwd")


def sequence_features(df: DataFrame, frames_col: str, dims: int, extra: list[str] | None = None) -> DataFrame:
    """Pooled sequence summaries (+ optional fixed vectors) as one feature vector ``x``."""
    pooled = pool_sequence(df, frames_col, dims)
    parts = [F.col(f"pool_{p}") for p in POOLS] + [F.col(c).cast("array<double>") for c in (extra or [])]
    return pooled.withColumn("x", F.concat(*parts)).drop(*[f"pool_{p}" for p in POOLS])


def train_sequence_model(rows: DataFrame, *, id_col: str = "id", frames_col: str = "frames", dims: int = 2,
                         label_col: str = "labels_hot", extra: list[str] | None = None,
                         shards: int | None = None, per_shard: int | None = None, shard_col: str = "shard",
                         ratio: float = VALIDATION_RATIO, seed: int = 7, epochs: int = 200, batch_size: int = 32,
                         lr: float = 0.5, patience: int = EARLY_STOP_PATIENCE) -> LinearModel:
    df = rows
    if shards is not None:
        df = limit_values(df, shard_col, shards)
    if per_shard is not None:
        df = limit_per_group(df, shard_col, [id_col], per_shard).drop("rn")
    # the prepared features are read by the split, the statistics and every
    # epoch: write them once to the shared checkpoint folder (cuts the lineage,
    # survives executor loss) instead of recomputing the upstream plan each time
    checkpoint_root(rows.sparkSession)
    df = sequence_features(df, frames_col, dims, extra).checkpoint(eager=True)
    df = split_holdout(df, id_col, ratio, seed)
    train, dev = df.where(F.col("split") == "train"), df.where(F.col("split") == "dev")
    stats = feature_stats(train, "x")                       # train statistics only
    train, dev = standardise(train, "x", stats), standardise(dev, "x", stats)
    return fit_multilabel(train, "x", label_col, id_col, epochs=epochs, batch_size=batch_size, lr=lr,
                          validation=dev, patience=patience, keep_best=True)
