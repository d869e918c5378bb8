"""Label operators: histogram (A2), vocabulary fit (A3/T4/T5/W7), encoding (F1/F2),
slot lookup by join (J3) and coverage counts (A9).

Scale notes
-----------
* The histogram is ``explode`` + ``groupBy(label)``: partial (map-side)
  aggregation first, so a label carried by a third of all rows costs one row
  per map task, not a hot reducer.
* The vocabulary has at most K-1 rows by construction (top-k via
  ``TakeOrderedAndProject``); that bound is what makes it safe to hand to the
  encoder as a literal array or to broadcast in :func:`label_slot_join`.
* Encoding is a narrow projection: no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediafeat.functions.labels import multihot_positional, multihot_vocab

MAX_VOCAB = 100_000  # hard bound on what is ever collected or broadcast


def label_histogram(df: DataFrame, labels_col: str = "labels") -> DataFrame:
    """label bigint, cnt bigint: occurrences of each label over all rows."""
    return (df.select(F.explode(labels_col).alias("label"))
              .groupBy("label").agg(F.count(F.lit(1)).alias("cnt")))


def fit_label_vocab(df: DataFrame, k: int, order: str = "id", labels_col: str = "labels") -> DataFrame:
    """label, idx (0-based slot), cnt for the first K-1 labels.

    ``order='id'`` is the behaviour as coded in the source (sorted label ids);
    ``order='frequency'`` is the documented intent (most frequent first, ties by id).
    """
    if not 1 <= k - 1 <= MAX_VOCAB:
        raise ValueError(f"k must be in 2..{MAX_VOCAB + 1}")
    hist = label_histogram(df, labels_col)
    if order == "id":
        keys = [F.col("label").asc()]
    elif order == "frequency":
        keys = [F.col("cnt").desc(), F.col("label").asc()]
    else:
        raise ValueError("order must be 'id' or 'frequency'")
    top = hist.orderBy(*keys).limit(k - 1)
    # window over at most K-1 rows (bounded, fine as a single partition)
    return top.select("label", (F.row_number().over(Window.orderBy(*keys)) - 1).alias("idx"), "cnt")


def vocab_values(vocab: DataFrame) -> list[int]:
    """The fitted vocabulary in slot order (at most MAX_VOCAB rows, checked)."""
    rows = vocab.orderBy("idx").select("label").limit(MAX_VOCAB + 1).collect()
    if len(rows) > MAX_VOCAB:
        raise ValueError("vocabulary too large to inline")
    return [int(r[0]) for r in rows]


def encode_labels(df: DataFrame, vocab: DataFrame | list[int], k: int, labels_col: str = "labels",
                  out_col: str = "labels_hot", with_other: bool = True) -> DataFrame:
    """Append the vocabulary multi-hot vector (F2)."""
    values = vocab if isinstance(vocab, list) else vocab_values(vocab)
    return df.withColumn(out_col, multihot_vocab(F.col(labels_col), values, k, with_other))


def encode_positional(df: DataFrame, k: int, labels_col: str = "labels", out_col: str = "labels_hot") -> DataFrame:
    """Append the positional multi-hot vector (F1)."""
    return df.withColumn(out_col, multihot_positional(F.col(labels_col), k))


def label_slot_join(df: DataFrame, vocab: DataFrame, id_col: str = "id", labels_col: str = "labels") -> DataFrame:
    """id, slots array<int> (sorted, distinct), n_kept: slot lookup by a join (J3),
    one row per row of ``df`` (rows that share an id stay apart).

    The vocabulary side is bounded by K, so it is broadcast explicitly; equal rows
    are looked up once; rows with no labels survive through ``explode_outer``.
    """
    key = F.array_join(F.transform(labels_col, lambda x: F.coalesce(x.cast("string"), F.lit("?"))), ",")
    rows = df.groupBy(id_col, key.alias("_key")).agg(F.count(F.lit(1)).alias("_times"), F.first(labels_col).alias("_labels"))
    ex = rows.select(id_col, "_key", "_times", F.explode_outer("_labels").alias("label"))
    v = F.broadcast(vocab.select("label", "idx"))
    j = ex.join(v, "label", "left")
    slots = j.groupBy(id_col, "_key", "_times").agg(F.array_sort(F.collect_set("idx")).alias("slots"))
    out = slots.select(id_col, "slots", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))).alias("_i")).drop("_i")
    return out.withColumn("n_kept", F.size("slots").cast("bigint"))


def label_coverage(df: DataFrame, hot_col: str, positional_col: str | None = None) -> DataFrame:
    """n_rows, n_other (vocab encoding put the row in "other"), n_zero (positional all zero)."""
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.element_at(F.col(hot_col), -1) == 1.0).alias("n_other"),
            F.sum(F.aggregate(F.col(hot_col), F.lit(0.0), lambda a, x: a + x)).cast("bigint").alias("n_hot_slots")]
    if positional_col:
        aggs.append(F.count_if(F.array_max(F.col(positional_col)) == 0.0).alias("n_zero"))
    return df.agg(*aggs)
