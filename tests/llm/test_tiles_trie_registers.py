"""Hard negatives, the conversation trie and HyperMinHash classes against brute force:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing names, and
groups cut into more parts than they need."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediafeat.llm import conversation_trie as T
from mediafeat.llm import hard_negatives as N
from mediafeat.llm import hyperminhash as H
from mediafeat.llm import jaccard_join

VECTORS = "vec_id long, label int, embedding array<float>, id string, x double, tile long, anchor_id long, score string, `odd name` int"


# ---- hard negatives ---------------------------------------------------------
def hard(rows):
    """Every row against every anchor, in plain Python integers."""
    own = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        own.append((i, label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (i, label, v) in enumerate(own):
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), k, m == label, b) for b, (k, m, w) in enumerate(own) if b != a]
        for p, pid, _, _ in sorted(s for s in scored if s[2])[:5]:
            fit = [(s, k) for s, k, same, _ in sorted(scored) if not same and 30 * -p <= 100 * -s <= 90 * -p][:10]
            out += [(i, pid, r, k, -p, -s) for r, (s, k) in enumerate(fit, 1)]
    return sorted(out)


def vectors(n=400, seed=3):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(9)] for _ in range(4)]
    rows = []
    for i in range(n):
        v = [x + rng.gauss(0, .3) for x in base[i % 4]]
        rows.append((i, rng.randrange(3), [float(np.float32(x)) for x in v]))
    rows += [(100, 1, rows[100][2])] * 3 + [(100, 2, rows[5][2]), (0, 1, rows[1][2])]          # repeated ids and rows
    rows += [(1000 + k, k % 3, rows[8][2]) for k in range(40)]                                # ties
    rows += [(-100, 1, rows[3][2]), (-7, 9, rows[4][2]), (500, None, rows[1][2]), (600, 1, None), (None, 1, rows[2][2]),
             (700, 1, [1.0, None]), (800, 2, [float("nan")]), (900, 0, [float("inf"), 1.0]), (1100, 1, []), (1200, 2, [0.5] * 30), (1300, 1, [2.0])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", 1.0, 2, 3, "s", 4) for r in rows], VECTORS)


@pytest.mark.parametrize("size, per_unit", [((256, 1024), (4, 8)), ((2, 32), (1, 1))])
def test_hard_negatives_are_those_of_brute_force(spark, size, per_unit):
    rows = vectors()
    got = N.mine(N.relabelled(frame(spark, rows).repartition(3)), size=size, per_unit=per_unit).collect()
    assert sorted(map(tuple, got)) == hard(rows)


def test_hard_negatives_of_nothing(spark):
    for rows in ([], [(100, 1, [1.0])], [(100, 1, [1.0]), (101, 1, [1.0])]):
        assert N.mine(N.relabelled(frame(spark, rows))).collect() == []


def test_half_of_all_rows_are_one_vector(spark):
    rows = vectors(200) + [(100 * k, k % 2, [1.0] * 9) for k in range(20)] + [(2001, 1, [1.0] * 9)] * 300
    got = N.mine(N.relabelled(frame(spark, rows).repartition(4)), size=(8, 64), per_unit=(1, 2)).collect()
    assert sorted(map(tuple, got)) == hard(rows)


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 3), (64, 33, 129), (40, 100, 41)])
def test_strassen_is_exact(shape):
    n, k, m = shape
    rng = np.random.default_rng(n)
    a, b = rng.integers(-1 << 24, 1 << 24, (n, k)), rng.integers(-1 << 24, 1 << 24, (k, m))
    assert (N.strassen(a, b, 4) == a @ b).all()


def test_products_that_do_not_fit_are_refused(spark):
    with pytest.raises(Exception, match="64 bits"):
        N.mine(N.relabelled(frame(spark, [(100, 1, [1e30]), (101, 1, [1.0])]))).collect()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(1)
    slot, score, ids = rng.integers(0, 5, 900), rng.integers(0, 30, 900), rng.permutation(900)
    whole, parts = N.Heaps(5, 7), N.Heaps(5, 7)
    whole.offer(slot, score, ids)
    for c in np.array_split(rng.permutation(900), 11):
        parts.offer(slot[c], score[c], ids[c])
    assert all((getattr(whole, f) == getattr(parts, f)).all() for f in ("slot", "score", "id", "least"))


# ---- conversation trie ------------------------------------------------------
def trie(rows, block=20, heads=4):
    """One dictionary entry for each prefix."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            key = hashlib.sha256(f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest()[:16]
            by[c].append((t is not None, t or 0, key, r or "", x or ""))
    seqs = {}
    for c, turns in by.items():
        h, base = zlib.crc32(str(c).encode()) % heads, c - int(math.fmod(c, block))
        seqs[c] = tuple(t[3:] for t in sorted(by.get(base, []))[:h] + sorted(turns)[h:])
    member, end = defaultdict(list), defaultdict(list)
    for c, s in seqs.items():
        end[s].append(c)
        for d in range(len(s) + 1):
            member[s[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in sorted(member, key=len, reverse=True):
        if not kids[p]:
            leaves[p] = 1
        saved[p] += (len(member[p]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0)
        if p:
            up = p[:-1]
            kids[up], leaves[up], saved[up] = kids[up] + 1, leaves[up] + leaves[p], saved[up] + saved[p]
    return sorted((min(m), len(p), min(member[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(end[p]))).encode()).hexdigest()) for p, m in member.items())


TURNS = "conv_id long, turn long, role string, text string, pos int, what binary, key string, words long, n int"


def talk(spark, rows):
    return spark.createDataFrame([(*r, 1, b"x", "k", 2, 3) for r in rows], TURNS)


def chats(n=120, seed=5):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "bot"]), f"say {rng.randrange(4)} \n now") for c in range(n) for t in range(rng.randrange(1, 7))]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(3)]              # copies
    rows += [(300, t, "user", f"alone {t}") for t in range(700)]                                  # one long conversation
    rows += [(c, t, "user", f"long {min(t, 60)}") for c in (320, 321) for t in range(90)]         # two long ones, equal but at the start
    rows += [(-3, 0, "a", "b"), (-20, 1, None, None), (-20, None, "first", ""), (5, 0, "user", "again"), (5, 0, "user", "again"),
             (None, 1, "lost", "lost"), (400, 0, "r", " \t\n"), (41, 9, None, "x")]
    return rows


def nodes(out):
    return sorted((tuple(r) for r in out.collect()))


@pytest.mark.parametrize("how", [{}, {"shard": 25, "fan": 2}, {"shard": 1, "fan": 3}])
def test_trie_is_that_of_brute_force(spark, how):
    rows = chats()
    got = T.trie(T.rebuilt(talk(spark, rows).repartition(4)), **how)
    assert nodes(got) == trie(rows)


def test_trie_with_a_conversation_cut_into_blocks(spark, monkeypatch):
    from mediafeat.operators import ordering
    monkeypatch.setattr(ordering, "HOT_ROWS", 50)
    rows = chats(30)
    assert nodes(T.trie(T.rebuilt(talk(spark, rows)))) == trie(rows)


def test_trie_of_little(spark):
    assert T.trie(T.rebuilt(talk(spark, []))).collect() == []
    for rows in ([(None, 0, "a", "b")], [(0, None, None, None)], [(c, 0, "u", "t") for c in range(300)]):
        assert nodes(T.trie(T.rebuilt(talk(spark, rows)))) == trie(rows)


def test_pieces_of_ids_make_one_hash(spark, monkeypatch):
    ids = spark.range(20_000).select(F.lit("k").alias("key"), "id")
    got = T._ends(ids.withColumnRenamed("id", "conv_id")).collect()
    assert [r.ends_sha256 for r in got] == [hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest()]


def test_search_tree_is_balanced():
    tree = T.Tree()
    for m in T._medians(1023):
        tree.insert([m], [1])
    depth = {0: 0, tree.eq[0]: 1}
    for t in sorted(range(1, 1024)):
        for x in (tree.lo[t], tree.hi[t]):
            if x:
                depth[x] = depth[t] + 1
    assert max(depth.values()) == 10 and len(tree.sym) == 1024


# ---- HyperMinHash -----------------------------------------------------------
def sets(texts, n):
    out = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        out[i] = ({tuple(w)} if w else set()) if len(w) < n else {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
    return out


def linked(texts, n, num, den):
    s = sets(texts, n)
    root = {i: i for i in s}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    by = defaultdict(set)
    for i, u in s.items():
        for g in u:
            by[g].add(i)
    for a, b in {p for m in by.values() for p in itertools.combinations(sorted(m), 2)}:
        both = len(s[a] & s[b])
        if den * both >= num * (len(s[a]) + len(s[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s[i]), find(i), find(i) == i) for i in s}


def prose(seed=11):
    """Groups of near copies of one text, a template that does not link, short texts."""
    rng = random.Random(seed)
    word = [f"w{i}" for i in range(3000)]
    docs = []
    for size in (2, 3, 9, 40):
        base = rng.choices(word, k=rng.randrange(60, 300))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, len(base) // 35 + 1)):
                copy[rng.randrange(len(copy))] = rng.choice(word)
            docs.append(copy)
    template = rng.choices(word, k=120)
    docs += [template + rng.choices(word, k=50) for _ in range(60)]                    # 0.54 alike
    docs += [rng.choices(word[:3], k=rng.randrange(1, 8)) for _ in range(40)]         # few shingles
    docs += [rng.choices(word, k=30) for _ in range(30)]
    texts = [" ".join(d) for d in docs]
    return [*enumerate(texts), (900, None), (901, ""), (902, " \t"), (903, texts[0].upper()), (904, texts[1]), (905, "w " * 40_000)]


@pytest.mark.parametrize("how, n", [({}, 4), ({"work": 20, "block": 3}, 4), ({"work": 1 << 22, "block": 2}, 2), ({"work": 0}, 4)])
def test_classes_are_those_of_brute_force(spark, how, n):
    texts = prose()
    df = spark.createDataFrame([(i, t, 1, "a", 2) for i, t in texts], "doc_id long, text string, size int, fp string, band int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in H.classes(df, n, 80, 100, **how).collect()}
    assert got == linked(texts, n, 80, 100)


def test_units_bring_every_outsider_to_every_member_once(spark):
    rows = [(1, i, i, 0, 100 if i < 20 else i, 50, 30, i >= 20) for i in range(50)]
    open_ = spark.createDataFrame(rows, "key long, fp long, doc long, band int, root long, n long, n_out long, out boolean")
    units = defaultdict(lambda: ([], []))
    for r in H._units(open_, 7).collect():
        units[r.unit][r.side].append(r.fp)
    met = [(a, b) for left, right in units.values() for a in left for b in right]
    assert sorted(met) == sorted((a, b) for a in range(20, 50) for b in range(50))
    assert max(len(side) for u in units.values() for side in u) < 20


def test_classes_without_ids_and_without_rows(spark):
    kind = "doc_id long, text string"
    assert H.classes(spark.createDataFrame([], kind)).collect() == []
    got = H.classes(spark.createDataFrame([(None, "a b c d e"), (None, None), (3, "a b c d e"), (3, "x y z"), (3, "a b c d e")], kind)).collect()
    assert sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got))) == sorted(map(str, [
        (None, 2, None, True), (None, 0, None, True), (3, 2, 3, True), (3, 1, 3, True), (3, 2, 3, True)]))


def test_registers_agree_as_often_as_the_sets_are_alike():
    rng = np.random.default_rng(2)
    for size in (6, 60, 3000):
        for alike in (0.3, 0.8, 1.0):
            seen, chance = [], []
            for _ in range(200):
                both = round(2 * size * alike / (1 + alike))
                u = rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64) * np.uint64(2)
                a, b = np.sort(u[:size]), np.sort(u[size - both:2 * size - both])
                ra, rb = H.registers([a, b])
                n = np.array([size])
                seen.append(H.estimate(ra[None], rb[None], n, n)[0])
                chance.append(both / (2 * size - both))
            assert abs(np.mean(seen) - np.mean(chance)) < 0.02


def test_chance_agreements_are_those_expected():
    rng = np.random.default_rng(4)
    old = H.MANTISSA
    agree = []
    for _ in range(300):
        ra, rb = H.registers([np.sort(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)) for _ in range(2)])
        agree.append((ra == rb).mean())
    step = round(4 * math.log2(4000 / H.REGISTERS))
    assert old == 10 and 0.2 * H._chance(step, step) < np.mean(agree) + 1e-4 and np.mean(agree) < 5 * H._chance(step, step) + 1e-4


def test_jaccard_join_gives_the_same_classes(spark):
    df = spark.createDataFrame(prose(7), "doc_id long, text string")
    a = {r.doc_id: r.component_id for r in H.classes(df).collect()}
    b = {r.doc_id: r.component_id for r in jaccard_join.link_classes(df, 4, 80, 100).collect()}
    assert a == b
