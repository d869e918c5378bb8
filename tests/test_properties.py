"""Property tests: label encoders against a direct Python statement of the rules."""
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mediafeat.operators import labels as L

bags = st.lists(st.lists(st.integers(min_value=-2, max_value=30), max_size=6), min_size=1, max_size=40)


def _vocab(rows, k, order):
    counts = Counter(l for r in rows for l in set(r))  # a label counts once per row here
    if order == "id":
        keys = sorted(counts)
    else:
        keys = sorted(counts, key=lambda l: (-counts[l], l))
    return keys[:k - 1]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=bags, k=st.integers(min_value=2, max_value=12), order=st.sampled_from(["id", "frequency"]))
def test_vocab_and_multihot_match_rules(spark, rows, k, order):
    # labels are deduplicated per row, as the bag fixtures are (collect_set)
    data = [(i, sorted(set(r))) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, labels array<long>")
    vocab = L.fit_label_vocab(df, k, order)
    got_vocab = [r["label"] for r in vocab.orderBy("idx").collect()]
    want_vocab = _vocab([r for _, r in data], k, order)
    assert got_vocab == want_vocab
    enc = {r["id"]: list(r["labels_hot"]) for r in L.encode_labels(df, got_vocab, k).collect()}
    pos = {r["id"]: list(r["labels_hot"]) for r in L.encode_positional(df, k).collect()}
    for i, labels in data:
        hot = [0.0] * k
        for j, v in enumerate(want_vocab):
            if v in labels:
                hot[j] = 1.0
        if not any(hot[:k - 1]):
            hot[k - 1] = 1.0
        assert enc[i] == hot
        assert pos[i] == [1.0 if j in labels else 0.0 for j in range(k)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=1, max_value=400), ratio=st.sampled_from([0.0, 0.05, 0.2, 0.5, 0.9]),
       seed=st.integers(min_value=0, max_value=10**6))
def test_split_size_and_keys(spark, n, ratio, seed):
    import hashlib
    import math

    from mediafeat.operators import split as P
    df = spark.createDataFrame([(str(i),) for i in range(n)], "id string")
    dev = {r["id"] for r in P.split_holdout(df, "id", ratio, seed).where("split = 'dev'").collect()}
    dev_n = max(1, math.floor(n * ratio))
    keys = sorted(((hashlib.md5(f"{i}#{seed}".encode()).hexdigest(), str(i)) for i in range(n)), reverse=True)
    assert dev == {i for _, i in keys[:dev_n]}


steps = st.lists(st.tuples(st.integers(min_value=0, max_value=5), st.integers(min_value=0, max_value=1000),
                           st.floats(min_value=-100, max_value=100, allow_nan=False)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=steps, t=st.integers(min_value=1, max_value=6))
def test_sequences_match_rules(spark, rows, t):
    from mediafeat.operators import sequences as S
    data = [(vid, ts, i, v) for i, (vid, ts, v) in enumerate(rows)]  # i breaks ts ties
    df = spark.createDataFrame(data, "id long, ts long, ord long, v double")
    seq = S.assemble_sequences(df, "id", ["ts", "ord"], "v", t, "seq")
    got = {r["id"]: (list(r["seq"]), r["n_steps"]) for r in seq.collect()}
    want = {}
    for vid in {d[0] for d in data}:
        ordered = [d[3] for d in sorted(d for d in data if d[0] == vid)]
        want[vid] = (ordered[:t], len(ordered))
    assert got == want
    pad = {r["id"]: (list(r["seq"]), r["true_len"]) for r in S.fix_length(seq, "seq", t, "pad").collect()}
    drop = {r["id"] for r in S.fix_length(seq, "seq", t, "drop").collect()}
    for vid, (s, n) in want.items():
        assert pad[vid] == (s + [0.0] * (t - len(s)), len(s))
        assert (vid in drop) == (n >= t)
