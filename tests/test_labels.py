
from mediafeat.operators import labels as L

SCHEMA = "id long, labels array<long>"


def _bags(spark):
    return spark.createDataFrame(
        [(1, []), (2, [99, 98]), (3, [1, 1, 2]), (4, [3]), (5, [2, 5, 7])], SCHEMA)


def test_vocab_by_id_and_frequency(spark):
    df = _bags(spark)
    by_id = [tuple(r) for r in L.fit_label_vocab(df, 4, "id").orderBy("idx").collect()]
    assert by_id == [(1, 0, 2), (2, 1, 2), (3, 2, 1)]
    by_freq = [r["label"] for r in L.fit_label_vocab(df, 4, "frequency").orderBy("idx").collect()]
    assert by_freq == [1, 2, 3]  # counts 2,2 then ties at 1 broken by id


def test_multihot_vocab_edge_cases(spark):
    df = _bags(spark)
    enc = L.encode_labels(df, L.fit_label_vocab(df, 5, "id"), 5)
    got = {r["id"]: list(r["labels_hot"]) for r in enc.collect()}
    assert got[1] == [0, 0, 0, 0, 1]      # empty list -> "other"
    assert got[2] == [0, 0, 0, 0, 1]      # only unknown labels -> "other"
    assert got[3] == [1, 1, 0, 0, 0]      # duplicates count once
    assert got[4] == [0, 0, 1, 0, 0]
    assert got[5] == [0, 1, 0, 1, 0]


def test_vocab_shorter_than_k(spark):
    df = spark.createDataFrame([(1, [4]), (2, [6])], SCHEMA)
    enc = L.encode_labels(df, L.fit_label_vocab(df, 6, "id"), 6)
    got = {r["id"]: list(r["labels_hot"]) for r in enc.collect()}
    assert got == {1: [1, 0, 0, 0, 0, 0], 2: [0, 1, 0, 0, 0, 0]}  # unused middle slots stay 0


def test_positional_and_slot_join_agree(spark):
    df = _bags(spark)
    vocab = L.fit_label_vocab(df, 4, "id")
    enc = L.encode_labels(df, vocab, 4)
    slots = L.label_slot_join(df, vocab)
    kept = {r["id"]: int(sum(r["labels_hot"][:-1])) for r in enc.collect()}
    assert kept == {r["id"]: r["n_kept"] for r in slots.collect()}
    pos = L.encode_positional(df, 3).collect()
    assert {r["id"]: list(r["labels_hot"]) for r in pos}[3] == [0, 1, 1]


def test_encode_is_narrow(spark):
    df = _bags(spark)
    plan = L.encode_labels(df, [1, 2, 3], 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
