"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra
columns with clashing names, for every operator and stage."""

import hashlib

import pytest

import corpus_pipeline
from mediafeat.llm import fingerprint, jaccard_join, language_id, lm_score, mixing, piece_sampling, quality_rules, sharding, suffix_dedup, toxicity

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, blk long, kid string, skey string, "
          "_row string, score double, label int, tox_x string, `odd name` string")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
NEAR = " ".join(f"n{i}" for i in range(200))


def rows():
    tail = (7, 7, "k", "s", "r", 0.5, 1, "t", "o")
    texts = [(1, "the cat sat on the mat and looked at the dog that sat on the mat", "en", "a"), (2, None, "en", "a"), (3, "", None, None),
             (4, " \t\n", "en", ""), (5, LONG, "en", "b"), (6, LONG, None, "b"), (7, NEAR, "de", "a"), (8, NEAR + " end", "de", None),
             (8, NEAR + " end", "de", None), (9, "x", "de", "c"), (10, "▁ \U0001F600 é\n\n  ▁", "fr", "c"), (None, "no id here at all", "en", "a"),
             (None, None, None, None), (11, "You idiot! " * 30, "en", "b"), (12, "aaaa" * 400, "en", "b"), (13, "one two three", "en", "c")]
    return [(i, t, la, s, len(t or ""), *tail) for i, t, la, s in texts]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (11, 0, 1), (5, 1, 0), (7, None, None), (None, 1, 1), (9, 0, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


OPERATORS = {
    "suffix": lambda d, la: suffix_dedup.report(d), "lm": lambda d, la: lm_score.score_documents(d), "mix": lambda d, la: mixing.mix_report(d),
    "pieces": lambda d, la: piece_sampling.encode(d), "language": lambda d, la: language_id.identify(d),
    "shard": lambda d, la: sharding.shard_documents(d, 24), "rules": lambda d, la: quality_rules.judge(d, la)[0],
    "fingerprint": lambda d, la: fingerprint.edited_report(d), "toxicity": lambda d, la: toxicity.scored(d, la),
    "jaccard": lambda d, la: jaccard_join.link_classes(d)}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(name, odd, labels):
    out = OPERATORS[name](odd, labels).collect()
    if name == "pieces":
        out = [r for r in out if r["sample"] == 1]
    assert len(out) == len(rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, none, no_labels):
    assert OPERATORS[name](none, no_labels).collect() == []


@pytest.mark.parametrize("name", ["rules", "toxicity"])
def test_no_labels(name, odd, no_labels):
    assert OPERATORS[name](odd, no_labels).count() == len(rows())


STAGES = {"suffix-dedup": lambda d, la: suffix_dedup.without_repeats(d), "jaccard": lambda d, la: jaccard_join.one_of_each(d),
          "toxicity": lambda d, la: toxicity.without_toxic(d, la), "mix": lambda d, la: mixing.mix(d)}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns(name, odd, none, labels, no_labels):
    out = STAGES[name](odd, labels)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    assert 0 < out.count() <= 3 * len(rows())
    assert STAGES[name](none, no_labels).collect() == []


def test_stage_names_have_functions():
    assert all(callable(f) for _, f in corpus_pipeline.STAGES)


def test_suffix_repeats_within_and_across(odd):
    got = {}
    for r in suffix_dedup.report(odd).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[5][0].n_removed == 0 and got[6][0].n_removed == len(LONG) and got[6][0].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[8][0] == got[8][1] and got[8][0].n_removed >= len(NEAR) - 1       # a repeated row is one document
    assert got[12][0].n_removed == 1599 and got[12][0].n_spans == 1              # only the first string of 100 starts first
    assert got[2][0].n_bytes == got[3][0].n_bytes == 0


def test_suffix_rows_of_one_id_with_other_texts(spark):
    t = " ".join(f"w{i}" for i in range(100))
    d = spark.createDataFrame([(1, t), (1, "q" + t), (2, t)], "doc_id long, text string")
    out = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.report(d).collect())
    assert out[2] == (2, len(t), len(t)) and sum(x[2] for x in out[:2]) == len(t)


def test_long_text_in_pieces(spark):
    import random
    random.seed(3)
    part = "".join(random.choice("abcdefgh ") for _ in range(3000))
    t = part + "".join(random.choice("ijklmnop ") for _ in range(2000)) + part
    d = spark.createDataFrame([(1, t)], "doc_id long, text string")
    for piece in (512, 1 << 20):
        r = suffix_dedup.report(d, piece=piece).first()
        assert (r.n_removed, r.n_spans) == (3000, 1)


def test_jaccard_edges(odd):
    got = {}
    for r in jaccard_join.link_classes(odd).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert got[2] == [(0, 2)] and got[3] == [(0, 3)] and got[4] == [(0, 4)]      # empty sets link with nothing
    assert got[6][0][1] == 5 and got[8][0][1] == got[8][1][1] == 7 and got[9] == [(1, 9)] and got[13] == [(1, 13)]
    assert all(c is None for _, c in got[None])


def test_jaccard_group_of_near_copies_below_and_above(spark):
    """A chain of near copies: neighbours link, the ends do not."""
    base = [f"t{i}" for i in range(120)]
    chain = []
    for k in range(40):
        chain.append((k, " ".join(base)))
        base[3 * k % 120] = f"new{k}"
    d = spark.createDataFrame(chain + [(100, " ".join(f"z{i}" for i in range(120)))], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.link_classes(d).collect()}
    assert all(got[k] == 0 for k in range(40)) and got[100] == 100


def test_fingerprint_sketches(spark):
    from pyspark.sql import functions as F
    a, b = " ".join(f"a{i}" for i in range(3000)), " ".join(f"b{i}" for i in range(3000))
    d = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, ab string")
    s = d.select(*[fingerprint.sketch(F.col(c)).alias(c) for c in d.columns])
    r = s.select(fingerprint.resemblance(F.col("a"), F.col("ab")).alias("r"), fingerprint.containment(F.col("a"), F.col("ab")).alias("c"),
                 fingerprint.distinct_count(F.col("a")).alias("n"), fingerprint.decode(fingerprint.encode(F.col("a"))).alias("back"), "a",
                 fingerprint.resemblance(fingerprint.merge(F.col("a"), F.col("b")), F.col("ab")).alias("m")).first()
    assert abs(r.r - 0.5) < 0.15 and r.c > 0.75 and abs(r.n - 2996) < 900 and r.back == r.a and r.m > 0.95


def test_sharding_map_versions(spark, tmp_path):
    d = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(2000)], "doc_id long, text string")
    recs = sharding.records(d, 256)
    first = sharding.build_map(recs, 8, str(tmp_path))
    more = sharding.edit_map(recs, spark.read.parquet(f"{tmp_path}/version=1"), 9, str(tmp_path))
    a, b = ({r.vslot: r.shard for r in m.collect()} for m in (first, more))
    assert {r.version for r in more.collect()} == {2}
    moved = [k for k in a if a[k] != b[k]]
    assert all(b[k] == 8 for k in moved) and 0 < len(moved) < 256 / 4      # slots only leave for the new shard
    load = more.groupBy("shard").sum("bytes").collect()
    assert max(r[1] for r in load) < 1.3 * min(r[1] for r in load)


def test_splitting_tree_is_exact():
    t = mixing.split_quotas([100, 7, 0, 33], 7, 1)
    assert t.sum(0).tolist() == [100, 7, 0, 33] and max(t.sum(1)) - min(t.sum(1)) <= 1 and (t >= 0).all()


def test_mixture_learns_from_counts():
    # a context bucket whose pair estimate is right all the time leans on it
    g = lm_score.GRID
    w = lm_score.mixture({(5 * g + 40) * g + 20: 1000, (1 * g + 0) * g + 30: 1000})
    assert w[5, 0] > 0.9 and w[1, 1] > 0.9 and w[0, 0] == 0


def test_sampling_follows_the_lattice():
    import math

    import numpy as np
    v = piece_sampling.Vocabulary()
    index = {p: i for i, p in enumerate(v.pieces)}

    def all_of(t):
        if not t:
            return [((), 0.0)]
        return [((int(v.ids[index[t[:n]]]), *rest), v.weight[index[t[:n]]] + w) for n in range(1, len(t) + 1) if t[:n] in index
                for rest, w in all_of(t[n:])]
    exact = {s: math.exp(w) for s, w in all_of("▁cat▁a")}
    total = sum(exact.values())
    got = list(piece_sampling.samples(v, ["cat a"], np.array([5], np.uint64), 1000))
    assert {tuple(x[2].tolist()) for x in got} == set(exact) and len(got) == len(exact)     # each once, all of them
    assert all(abs(math.exp(x[3]) - exact[tuple(x[2].tolist())] / total) < 1e-9 for x in got)
    n = 4000
    first = [tuple(x[2].tolist()) for x in piece_sampling.samples(v, ["cat a"] * n, piece_sampling.K.mix(np.arange(n).astype(np.uint64)), 1)]
    for s, p in exact.items():
        assert abs(first.count(s) / n - p / total) < 0.03


def test_samples_do_not_depend_on_the_batch(spark, odd):
    a = {(r.doc_id, r["sample"], r.n_chars): r.ids_sha256 for r in piece_sampling.encode(odd).collect()}
    b = {(r.doc_id, r["sample"], r.n_chars): r.ids_sha256 for r in piece_sampling.encode(odd.coalesce(1)).collect()}
    assert a == b


def test_decoding_gives_the_text(odd):
    out = piece_sampling.decode(piece_sampling.encode(odd.where("doc_id = 10"), k=3)).collect()
    assert len(out) == 3 and all(r.decoded == "▁ \U0001F600 é\n\n  ▁" for r in out)
