"""Train on video-level records and evaluate on held-out records (entry A of the
source, re-aimed).

The source reads both record sets, leaves the planner through ``.rdd``, maps
rows to NumPy pairs, fits asynchronously through an external parameter server
and finally collects the whole test set to the driver (twice) to score it.
Here: one scan per record set with only the two needed fields decoded,
positional multi-hot targets as a JVM expression (F1), the synchronous
data-parallel fit (M1), and evaluation as an executor-side aggregate (A7):
only weights and a few numbers reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediafeat.defaults import BATCH_SIZE, EPOCHS, LABEL_SLOTS
from mediafeat.functions.labels import multihot_positional
from mediafeat.operators.metrics import topclass_accuracy
from mediafeat.operators.train import LinearModel, fit_multilabel
from mediafeat.sources.records import read_good, read_records

FEATURE_SCHEMA = T.StructType([T.StructField("id", T.StringType()),
                               T.StructField("mean_rgb", T.ArrayType(T.FloatType())),
                               T.StructField("labels", T.ArrayType(T.LongType()))])


def load_pairs(spark: SparkSession, path: str, k: int) -> DataFrame:
    """(id, features, label) from video-level records: mean_rgb and the
    positional multi-hot of the labels (ids 0..k-1 only)."""
    rows = read_good(read_records(spark, path, FEATURE_SCHEMA, "Example"))
    return rows.select("id", F.col("mean_rgb").cast("array<double>").alias("features"),
                       multihot_positional("labels", k).alias("label"))


def train_and_evaluate(spark: SparkSession, train_path: str, test_path: str, k: int = LABEL_SLOTS,
                       epochs: int = EPOCHS, batch_size: int = BATCH_SIZE, lr: float = 0.5,
                       n_partitions: int | None = None) -> tuple[LinearModel, DataFrame]:
    train = load_pairs(spark, train_path, k)
    model = fit_multilabel(train, "features", "label", "id", epochs=epochs, batch_size=batch_size, lr=lr,
                           n_partitions=n_partitions)
    test = load_pairs(spark, test_path, k)
    scored = test.withColumn("scores", model.score_expr("features", spark))
    return model, topclass_accuracy(scored, "label", "scores")
