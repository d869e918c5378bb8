"""Vocabularies of any size and sparse encoding."""
import pytest
from pyspark.sql import functions as F

from mediafeat.operators import labels as L
from mediafeat.operators import sparse_labels as SL

BAG = "id long, labels array<long>"


def test_large_vocabulary_against_arithmetic(spark):
    """200,000 labels: row i has i and i + 1 (mod n), the slot of a label is its rank."""
    n = 200_000
    df = spark.range(n).select("id", F.array((F.col("id") * 3).alias("a"), ((F.col("id") + 1) % n * 3).alias("b")).alias("labels"))
    vocab = SL.fit_slots(df)
    assert vocab.count() == n
    assert vocab.where("idx * 3 <> label or cnt <> 2").isEmpty()
    enc = SL.encode_sparse(df, vocab, n + 1)
    i, j = F.col("id"), (F.col("id") + 1) % n
    wrong = enc.where((F.col("labels_sparse.slots") != F.array(F.least(i, j), F.greatest(i, j))) | (F.size("labels_sparse.values") != 2))
    assert enc.count() == n and wrong.isEmpty()


def test_blocks_of_the_vocabulary_number_like_one_window(spark, monkeypatch):
    from mediafeat.operators import ordering
    df = spark.range(5000).select(F.array((F.col("id") * 7919 % 4001)).alias("labels"))
    plain = {tuple(r) for r in SL.fit_slots(df, order="frequency").collect()}
    real = ordering.number_rows
    monkeypatch.setattr(SL, "number_rows", lambda d, g, o, out: real(d, g, o, out, hot_rows=50))
    assert {tuple(r) for r in SL.fit_slots(df, order="frequency").collect()} == plain


@pytest.mark.parametrize("order", ["id", "frequency"])
def test_dense_form_equals_dense_encoder(spark, order):
    rows = [(1, [5, 2, 2]), (2, [9]), (3, []), (4, None), (5, [2, None, 7]), (1, [5, 2, 2]), (6, [100])]
    df = spark.createDataFrame(rows, BAG)
    k = 4
    vocab = SL.fit_slots(df, k, order)
    old = L.fit_label_vocab(df.withColumn("labels", F.filter("labels", lambda x: x.isNotNull())), k, order)
    assert sorted(map(tuple, vocab.collect())) == sorted(map(tuple, old.collect()))
    got = SL.encode_sparse(df, vocab, k).select("id", SL.to_dense(F.col("labels_sparse")).alias("h"))
    want = L.encode_labels(df.withColumn("labels", SL.bag_of("labels")), old, k).select("id", F.col("labels_hot").alias("h"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == len(rows)          # repeated rows stay apart


def test_empty_table_and_no_other_slot(spark):
    empty = spark.createDataFrame([], BAG)
    vocab = SL.fit_slots(empty)
    assert vocab.isEmpty() and SL.encode_sparse(empty, vocab, 5).isEmpty()
    df = spark.createDataFrame([(1, [3]), (2, [])], BAG)
    got = {r.id: (r.labels_sparse.slots, r.labels_sparse["values"]) for r in SL.encode_sparse(df, SL.fit_slots(df), 1, with_other=False).collect()}
    assert got == {1: ([0], [1.0]), 2: ([], [])}
    assert [tuple(r) for r in SL.sparse_pairs(SL.encode_sparse(df, vocab, 5), "labels_sparse", "id").orderBy("id").collect()] == [(1, 4, 1.0), (2, 4, 1.0)]
    with pytest.raises(ValueError):
        SL.fit_slots(df, 1)


def test_hot_bag_and_hot_label(spark):
    """A third of the rows carry one bag, and every bag one label."""
    n = 9000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.array(F.lit(0), F.lit(1)).cast("array<bigint>"))
                               .otherwise(F.array(F.lit(0).cast("bigint"), F.col("id"))).alias("labels"))
    enc = SL.encode_sparse(df, SL.fit_slots(df), n + 1)
    assert enc.count() == n
    assert enc.where("labels_sparse.slots[0] <> 0").isEmpty()
    assert enc.where("id % 3 = 0 and labels_sparse.slots <> array(0L, 1L)").isEmpty()


def test_large_vocabulary_is_not_broadcast_by_its_estimate(spark, tmp_path):
    """Behind a small compressed file stand as many labels as it has rows."""
    spark.range(300_000).select((F.col("id") % 1000).alias("id"), F.col("id").alias("label")).write.parquet(str(tmp_path / "t"))
    bags = spark.read.parquet(str(tmp_path / "t")).groupBy("id").agg(F.collect_list("label").alias("labels"))
    for width, joins in ((300_001, 0), (100, 1)):       # the second: a vocabulary that fits
        enc = SL.encode_sparse(bags, SL.fit_slots(bags, width), width)
        assert str(enc._jdf.queryExecution().executedPlan().toString()).count("BroadcastHashJoin") == joins
    first = enc.where("id = 7").first().labels_sparse
    assert (first["size"], first["slots"], first["values"]) == (100, [7], [1.0])
