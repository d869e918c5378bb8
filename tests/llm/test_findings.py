"""Cases in which an operator once did less than the whole job."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pytest

from mediafeat.llm import common, jaccard_join, language_id, piece_sampling, sharding, suffix_dedup, toxicity
from mediafeat.llm import kernels as K


def _set(words: list[str]) -> np.ndarray:
    return next(u for _, u in jaccard_join._sets(*K.texts(pa.array([" ".join(words)])), 1))


def _hidden_pair() -> list[list[str]]:
    """Word sets n0 < n1 < n2 < n3 (by fingerprint) of which only n1 and n3 link at 0.8,
    while the signatures of n0 and n1, and of n2 and n3, are nearly the same."""
    bins: dict[int, list[str]] = {}
    for i in range(30_000):
        bins.setdefault(int(_set([f"w{i}"])[0] >> np.uint64(56)), []).append(f"w{i}")
    core = [f"core{i}" for i in range(100)]
    for seed in itertools.count():
        free = {b: iter(np.random.default_rng(seed).permutation(w).tolist()) for b, w in bins.items()}
        own = [[next(free[b]) for b in range(x, x + n)] for x, n in ((0, 20), (0, 12), (100, 20), (100, 12))]
        docs = [core + o for o in own]
        order = np.argsort([jaccard_join._fingerprint(_set(d)) for d in docs]).tolist()
        if order[0] in (0, 2) and order[1] in (1, 3) and order[2] in (0, 2):
            return docs


def test_jaccard_pairs_behind_likelier_ones_are_compared(spark):
    docs = _hidden_pair()
    own, more = [w for d in docs for w in d[100:112]], [w for d in docs for w in d[112:]]
    # the order: five words of the core, twelve own words, the rest of the core, more own words
    fill = [docs[0][5:100] * (i < 20) + own * (i < 12) + more + [f"x{i}y{k}" for k in range(600)] for i in range(40)]
    rows = [(i, " ".join(d)) for i, d in enumerate(docs + fill)]
    got = {r.doc_id: r.component_id for r in jaccard_join.link_classes(
        spark.createDataFrame(rows, "doc_id long, text string"), 1, 80, 100).collect()}
    assert got == {i: i for i, _ in rows} | {3: 1}


def test_toxic_stems_are_counted_over_all_labelled_rows(spark):
    def text(i):
        insult = "grobzak" if i % 200 == 0 else "dummkopf"      # the first in 20 texts of 4,000
        return f"some plain words number {i} " + (f"you {insult} go away" if i % 20 == 0 else "and nothing else here")
    docs = spark.createDataFrame([(i, text(i)) for i in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(4000)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels, max_rows=400).lexicon
    assert {"dumm", "grob", "grobzak"} <= lexicon.keys()
    whole = toxicity.fit(docs, labels).lexicon
    assert lexicon == whole


def test_suffix_strings_of_a_crowded_gram_meet_those_of_other_tasks(spark, monkeypatch):
    """Four surroundings of one passage in a task, the last of them also, earlier, in another task."""
    monkeypatch.setattr(suffix_dedup, "CROWD", 2)
    r = np.random.default_rng(5)

    def some(n):
        return "".join(r.choice(list("abcdefghijklmnopqrstuvwxyz "), n).tolist())
    early, crowd = [], []
    for g in range(24):
        passage = some(140)
        texts = [some(200) + passage + some(200) for _ in range(4)]
        early.append((g, some(150) + texts[3][60:480] + some(150)))
        crowd += [(100 + 10 * g + k, t) for k, t in enumerate(texts)]
    two = spark.createDataFrame(spark.sparkContext.parallelize([early, crowd], 2).flatMap(lambda x: x), "doc_id long, text string")
    got = {x.doc_id: (x.n_removed, x.kept_sha256) for x in suffix_dedup.report(two).collect()}
    seen, want = set(), {}
    for i, text in early + crowd:
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - 99):
            if text[at:at + 100] in seen:
                gone[at:at + 100] = True
            seen.add(text[at:at + 100])
        kept = "".join(c for c, x in zip(text, gone) if not x)
        want[i] = (int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())
    assert got == want


def test_jaccard_lists_in_pieces_and_blocks(spark):
    r = np.random.default_rng(3)
    page = [f"t{i}" for i in range(270)]
    sets = [page + [f"p{g}o{k}" for k in range(30)] for g in range(40)]      # 0.82 alike: no link
    sets += [page[:200] + [f"c{r.integers(60)}" for _ in range(20)] for _ in range(40)]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(sets)], "doc_id long, text string").repartition(4)
    sets = [set(x) for x in sets]
    lowest = list(range(len(sets)))
    links = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    for small in ({}, {"most": 8, "block": 8}):
        got = {x.doc_id: x.component_id for x in jaccard_join.link_classes(docs, 1, 85, 100, **small).collect()}
        assert got == dict(enumerate(lowest))


def test_jaccard_entries_too_late_in_their_sets_leave_a_list(spark):
    none = spark.createDataFrame([], "node long, root long")
    late = spark.createDataFrame([(1, fp, 300, 30) for fp in range(50)] + [(2, fp, 300, 5) for fp in range(20)],
                                 "h long, fp long, size long, pos long")
    got = jaccard_join._open_lists(late, none, 85, 100, 8).collect()
    assert {(x.h, x.blocks) for x in got} == {(2, 3)} and len(got) == 20


def test_language_letters_beyond_the_first_plane():
    _, _, letters = language_id._grams(["\U0001F600 12 \U0001F680!", "\U00020000\U0001F600", "ab"])
    assert letters.tolist() == [0, 1, 2]


def test_a_repeated_id_loses_no_clean_text(spark):
    near, far = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    other, lone = " ".join(f"c{i}" for i in range(60)), " ".join(f"d{i}" for i in range(60))
    rows = [(1, near), (2, near + " end"), (2, far), (3, other), (3, lone), (3, lone), (4, far + " end"), (None, near)]
    kept = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, near), (2, far), (3, other), (3, lone), (None, near)], key=str)


def test_copies_of_a_row_spread_over_shards(spark):
    """3,000 equal rows among 6,000: shards within 2 % of the mean bytes, chunks or not."""
    from pyspark.sql import functions as F
    docs = spark.range(6000).select(F.when(F.col("id") % 2 == 0, F.lit(8)).otherwise(F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") % 2 == 0, F.lit("the same text")).otherwise(F.concat(F.lit("text no "), F.col("id"))).alias("text"))
    rows = sharding.shard_documents(docs, 4, 2048).collect()
    load = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert len(rows) == 6000 and max(load) - min(load) <= 0.02 * sum(load) / 4, load
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    plain = sorted(map(tuple, sharding.records(docs, 64).collect()))
    assert sorted(map(tuple, sharding.records(docs, 64, chunk=7).collect())) == plain
    assert sum(r[0] == 8 for r in plain) == 3000


def test_a_pronoun_is_near_up_to_three_words_on_either_side(spark):
    """At the text's start as in its middle and at its end."""
    words = ["a", "b", "c", "d", "e", "f", "g", "h", "k", "m", "n", "o"]
    cases = []
    for i in range(len(words)):
        for j in range(len(words)):
            if i != j:
                t = list(words)
                t[i], t[j] = "badword", "you"
                cases.append((i, j, " ".join(t)))
    docs = spark.createDataFrame(cases, "i int, j int, text string")
    at = toxicity.FEATURES.index("near_you")
    for r in toxicity.features(docs, {"badw": True}).collect():
        assert r.tox_x[at] == float(abs(r.i - r.j) <= 3), (r.i, r.j)


def test_pipeline_samples_segmentations_without_replacement(spark):
    import corpus_pipeline
    texts = {1: "a quiet lake by the forest", 2: "un chat noir dort", 3: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {i: [] for i in texts}
    for r in corpus_pipeline.encode_pieces(spark, docs, "").collect():
        got[r.doc_id].append((r["sample"], tuple(r.ids), r.perturbed))
    assert {i: sorted(s for s, _, _ in rows) for i, rows in got.items()} == {1: [1, 2], 2: [1, 2], 3: [1]}
    for i in (1, 2):
        (_, a, x), (_, b, y) = sorted(got[i])
        assert a != b and x > y


def _shuffled(df) -> int:
    """Bytes that the shuffles of a plan wrote, once it has run."""
    df.collect()
    seen, left = {}, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            left.append(node.plan())
        else:
            if name == "Exchange":
                seen[node.id()] = node.metrics().apply("shuffleBytesWritten").value()
            left += [node.children().apply(i) for i in range(node.children().size())]
    return sum(seen.values())


@pytest.fixture
def merge_joins(spark):
    """Joins as of tables too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _hex_texts(n: int) -> list[str]:
    r = np.random.default_rng(11)
    return [" ".join(r.bytes(4).hex() for _ in range(400)) for _ in range(n)]


def test_dedup_and_near_copy_stages_shuffle_the_texts_concerned_alone(spark, merge_joins):
    texts = _hex_texts(200)
    texts[150] = texts[150][:1500] + texts[20][700:1200] + texts[150][1500:]     # a repeat
    texts[151] = texts[21][:-9]                                                 # a near copy
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    size = sum(map(len, texts))
    _, marks = suffix_dedup.repeats(docs)
    cut = suffix_dedup.without_repeats(docs)
    one = jaccard_join.one_of_each(docs)
    for df in (marks, cut, one):
        assert 0 < _shuffled(df) < size / 8
    assert {r.doc_id: r.text for r in one.collect()} == {i: t for i, t in enumerate(texts) if i != 151}
    want = dict(enumerate(texts)) | {150: texts[150][:1500] + texts[150][2000:]}
    del want[151]
    assert {r.doc_id: r.text for r in cut.collect()} == want


def test_rows_parted_by_a_table_of_ids(spark, monkeypatch):
    rows = spark.createDataFrame([(i if i >= 0 else None, f"t{i}") for i in range(-2, 3000)], "id int, `a.b` string")
    ids = spark.createDataFrame([(i,) for i in [*range(0, 3000, 7), 5_000_000_000] * 2], "x long")
    for bits, most in ((26, 1), (6, 3002)):
        monkeypatch.setattr(common, "ID_BITS", bits)
        here, others = common.parted(rows, "id", ids, "x")
        assert here.columns == others.columns == rows.columns
        near = [r.id for r in here.collect()]
        assert set(range(0, 3000, 7)) <= set(near) and len(near) < 429 + most
        assert sorted(r["a.b"] for r in here.union(others).collect()) == sorted(f"t{i}" for i in range(-2, 3000))


def _drawn(texts, words=None, k=3):
    v = words.v if words else piece_sampling.Vocabulary()
    keys = K.mix(np.arange(len(texts), dtype=np.uint64))
    return {(i, rank): (ids.tolist(), *(round(x, 6) for x in more)) for i, rank, ids, *more in piece_sampling.samples(v, texts, keys, k, *([words] if words else []))}


def test_words_are_solved_once_for_many_batches(monkeypatch):
    text = "the quick brown fox \u2581 \u6f22\u5b57 jumps\n"
    spans, find = [], piece_sampling.Vocabulary.find
    monkeypatch.setattr(piece_sampling.Vocabulary, "find", lambda self, h: spans.append(len(h)) or find(self, h))
    monkeypatch.setattr(piece_sampling, "RUN", len(text))         # each text is a batch of its own
    one = _drawn([text])
    once = sum(spans)
    many = _drawn([text] * 50)
    assert sum(spans) == 2 * once
    assert {r: many[0, r] for r in (1, 2, 3)} == {r: one[0, r] for r in (1, 2, 3)}


def test_samples_do_not_depend_on_the_words_solved_before(monkeypatch):
    v, rng = piece_sampling.Vocabulary(), np.random.default_rng(5)
    stock = ["the", "of", "and", *("".join(rng.choice(list("abcdehino\u00e9\u4e00\U0001F600"), rng.integers(1, 14))) for _ in range(400))]
    texts = [" ".join(rng.choice(stock[:n], 30)) for n in (3, 403) for _ in range(60)] + ["", " ", "\u2581", "a" * 3000, "x  y "]
    want = _drawn(texts)
    monkeypatch.setattr(piece_sampling, "RUN", 200)
    for room in (1, 2000, 12_000, 1 << 20):        # no word stays; those met again stay; all stay
        words = piece_sampling.Words(v, room)
        assert _drawn(texts, words) == want == _drawn(texts, words)
        assert words.edges <= room + 20_000 and len(np.unique(words.hash[:words.n])) == words.n


def test_samples_do_not_depend_on_the_choices_looked_at_first(monkeypatch):
    texts = [" ".join(["internationalisation of the", "漢", "a" * 40] * n) for n in (1, 3, 40, 200)] * 10
    want = _drawn(texts, k=4)
    for near in (1, 20, 1 << 30):
        monkeypatch.setattr(piece_sampling, "NEAR", near)
        assert _drawn(texts, k=4) == want


def test_op4_returns_the_token_ids_of_every_text(spark, tmp_path):
    from mediafeat.llm.queries import QUERIES
    texts = {1: "a quiet  lake by the forest\n", 2: "漢 \U0001F600 chat ▁", 3: None, 4: "x", 5: " ".join(["long text of many words"] * 3000)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op4_sentencepiece"](spark, str(tmp_path))
    assert dict(out.dtypes)["ids"] == "array<int>"
    rows = piece_sampling.decode(out).collect()
    for r in rows:
        assert r.decoded == (texts[r.doc_id] or "") and r.round_trip and len(r.ids) == r.n_pieces
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<i4").tobytes()).hexdigest()
    assert {i: len({tuple(r.ids) for r in rows if r.doc_id == i}) for i in texts} == {1: 2, 2: 2, 3: 1, 4: 2, 5: 2}
