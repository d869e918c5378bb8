"""Label vocabularies of any size and sparse encoding.

The dense encoders of ``labels`` inline a small vocabulary into the plan.  Here the
vocabulary stays a table, numbered without a window over all of it, and rows meet it by
a join: nothing is collected and no literal grows with the vocabulary.

Scale notes
-----------
* Histogram: partial aggregation; slots: :func:`ordering.number_rows`, which cuts a large
  table into blocks by value.
* Encoding works on distinct bags of labels, so equal rows are looked up once and a
  bag that a third of all rows carry costs one row per map task.  Rows meet their bag's
  code in one join, whose skewed side AQE may split.
* A label in most bags is a hot key of the lookup.  A vocabulary of at most
  ``BROADCAST`` slots is broadcast; a larger one, and the table of bags, meet by merge
  joins, whatever the planner estimates (it takes aggregates for no larger than the
  compressed files behind them): AQE splits the skewed side.

Null labels count as absent; a null or empty bag keeps its row, without slots (or with
the "other" slot); repeated rows stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediafeat.operators.labels import label_histogram
from mediafeat.operators.ordering import number_rows

BROADCAST = 100_000      # slots of a vocabulary that is broadcast


def fit_slots(df: DataFrame, k: int | None = None, order: str = "id", labels_col: str = "labels") -> DataFrame:
    """label, idx (0-based slot, bigint), cnt of the first ``k - 1`` labels (None: all), in
    the order of ``labels.fit_label_vocab``, whatever their number."""
    if k is not None and k < 2:
        raise ValueError("k must be at least 2")
    hist = label_histogram(df, labels_col).where("label is not null")
    if order == "id":
        keys = ["label"]
    elif order == "frequency":
        hist, keys = hist.withColumn("_rank", -F.col("cnt")), ["_rank", "label"]
    else:
        raise ValueError("order must be 'id' or 'frequency'")
    slots = number_rows(hist.withColumn("_all", F.lit(0)), ["_all"], keys, "_rn")
    if k is not None:
        slots = slots.where(F.col("_rn") <= k - 1)
    return slots.select("label", (F.col("_rn") - 1).cast("bigint").alias("idx"), "cnt")


def bag_of(labels_col: str) -> Column:
    """The distinct labels of a row, sorted, nulls left out (never null)."""
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(labels_col, lambda x: x.isNotNull()))), F.array())


def encode_sparse(df: DataFrame, vocab: DataFrame, width: int | Column, labels_col: str = "labels",
                  out_col: str = "labels_sparse", with_other: bool = True) -> DataFrame:
    """Append ``out_col``: struct<size bigint, slots array<bigint>, values array<double>>,
    the set slots in ascending order.

    ``width``: slots of the vector (``k``); with ``with_other`` the last of them is 1 for
    rows none of whose labels is in ``vocab`` (label, idx)."""
    size = (F.lit(width) if isinstance(width, int) else width).cast("bigint")
    bags = df.select(bag_of(labels_col).alias("_bag")).distinct()
    small = isinstance(width, int) and width <= BROADCAST
    slot = vocab.select("label", "idx").hint("broadcast" if small else "merge")
    found = (bags.select("_bag", F.explode("_bag").alias("label")).join(slot, "label")
             .groupBy("_bag").agg(F.array_sort(F.collect_set(F.col("idx").cast("bigint"))).alias("_slots")))
    # by a hash too: both sides are dealt for this join, so that AQE can split a bag that many rows carry
    key = F.xxhash64("_bag").alias("_key")
    rows = df.withColumn("_bag", bag_of(labels_col)).select("*", key).join(found.select("*", key).hint("merge"), ["_key", "_bag"], "left")
    other = F.array(size - 1) if with_other else F.array().cast("array<bigint>")
    slots = F.coalesce("_slots", other)
    return rows.withColumn("_slots", slots).withColumn(out_col, F.struct(
        size.alias("size"), F.col("_slots").alias("slots"), F.array_repeat(F.lit(1.0), F.size("_slots")).alias("values"))).drop("_key", "_bag", "_slots")


def sparse_pairs(df: DataFrame, sparse_col: str, *keep: str) -> DataFrame:
    """``keep`` columns, slot, value: a row for each set slot."""
    return df.select(*keep, F.explode(F.arrays_zip(f"{sparse_col}.slots", f"{sparse_col}.values")).alias("_e")).select(
        *keep, F.col("_e.slots").alias("slot"), F.col("_e.values").alias("value"))


def to_dense(sparse: Column) -> Column:
    """array<double> of a sparse vector, for widths that fit a row."""
    return F.transform(F.sequence(F.lit(0).cast("bigint"), sparse["size"] - 1),
                       lambda i: F.when(F.array_contains(sparse["slots"], i), F.lit(1.0)).otherwise(F.lit(0.0)))
