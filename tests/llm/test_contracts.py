"""The contract queries against brute force on the small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from mediafeat.llm.queries import ORACLE, QUERIES

from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}


def run(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF001).collect()}


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def words(text):
    return WORD.findall(text or "")


def low(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def test_op1_removes_exactly_the_repeated_strings(spark, docs):
    got, seen = run(spark, "op1_suffix_dedup"), set()
    assert len(got) == len(docs)
    for i in sorted(docs):
        b = (docs[i].text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            if w in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for k, y in enumerate(gone) if y and not (k and gone[k - 1]))
        assert tuple(got[i])[1:] == (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())


def test_op2_counts_and_base_score(spark, docs):
    got = run(spark, "op2_lm_score")
    tok = {i: words(low(r.text)) + [None] for i, r in docs.items()}
    c = Counter(t for i in tok if fold(i, 5) != 1 for t in tok[i])
    n, v = sum(c.values()), len(c)
    for i, t in tok.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(i, 5) == 1, len(t), sum(c[x] > 0 for x in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t))
        assert r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op3_targets_and_ceiling(spark, docs):
    from mediafeat.llm.mixing import targets
    got = run(spark, "op3_mix_sources")
    size = {i: len(words(r.text)) for i, r in docs.items()}
    by = Counter()
    for i, r in docs.items():
        by[r.source] += size[i]
    goal, taken = targets(list(by.items())), Counter()
    for i, r in got.items():
        assert (r.size, r.source_size) == (size[i], by[docs[i].source])
        assert r.target == pytest.approx(goal[docs[i].source])
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[docs[i].source] += r.taken
    assert sum(goal.values()) == pytest.approx(sum(by.values()))
    for s, t in goal.items():
        assert abs(taken[s] - t) <= max(size[i] for i in docs if docs[i].source == s)
    again = run(spark, "op3_mix_sources")
    assert {i: tuple(r) for i, r in got.items()} == {i: tuple(r) for i, r in again.items()}


def test_op4_round_trips_distinct_samples(spark, docs):
    rows = QUERIES["op4_sentencepiece"](spark, SF001).collect()
    assert {r.doc_id for r in rows} == set(docs)
    assert all(r.round_trip for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for group in by.values():
        assert len({r.ids_sha256 for r in group}) == len(group)
        assert all(0 <= r.inclusion <= 1 for r in group)
        assert [r.perturbed for r in sorted(group, key=lambda r: r.sample)] == sorted((r.perturbed for r in group), reverse=True)


def test_op5_predicts_held_out_languages(spark, docs):
    got = run(spark, "op5_language_id")
    held = [r for r in got.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if fold(i, 4) == 2}
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_op6_equal_bytes_and_gapless_slots(spark, docs):
    got = run(spark, "op6_shard")
    load, slots = Counter(), {}
    for i, r in got.items():
        b = (docs[i].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 8, zlib.crc32(b), "bytes", None)
        load[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(load) <= set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # no shard exceeds the mean by more than its heaviest slot
    assert max(load.values()) - sum(load.values()) / 24 <= max(r["size"] for r in got.values())


def test_op7_counts(spark, docs):
    got = run(spark, "op7_quality_rules")
    for i, d in docs.items():
        t, w = d.text or "", words(d.text)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        win = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        c, cover = Counter(win), set()
        for k, x in enumerate(win):
            if c[x] > 1:
                cover.update(range(k, k + 5))
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(cover), failed)
        assert not (failed and r.kept)


def test_op8_edits_and_likeness(spark, docs):
    got = run(spark, "op8_fingerprint")

    def shingles(t):
        w = words(t)
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    def jaccard(a, b):
        return len(a & b) / len(a | b) if a or b else 1.0
    order = sorted(docs, reverse=True)
    for k, i in enumerate(order):
        t, nxt = docs[i].text or "", docs[order[(k + 1) % len(order)]].text or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - jaccard(shingles(t), shingles(edited))) < 0.25
        assert abs(r.near_next - jaccard(shingles(t), shingles(nxt))) < 0.25


def test_op9_shape(spark, docs):
    got = run(spark, "op9_toxicity")
    assert set(got) == set(docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (fold(i, 4) == 2) for i, r in got.items())


def test_op10_equals_its_sql(spark, docs):
    from tests.harness import duck_con
    want = {r[0]: r[1:] for r in duck_con(SF001).execute(ORACLE["op10_jaccard_join"]).fetchall()}
    got = {i: (r.n_shingles, r.component_id) for i, r in run(spark, "op10_jaccard_join").items()}
    assert got == want


def test_pipeline(spark, docs):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard-join", "suffix-dedup", "mix", "sentencepiece"]
    rows = corpus_pipeline.run(spark, SF001).collect()
    assert rows and {r.doc_id for r in rows} <= set(docs) and all(r.round_trip for r in rows)
