"""N-gram Jaccard self-join by rare-first prefix filtering.

1. *Profile.*  One pass gives every document's set size, a fingerprint of its
   shingle set, and a 256-bin count signature; equal sets collapse to one node.  The
   same pass counts document frequencies of shingles in a fixed-size table of
   hashed counters.  The table only orders shingles: any total order that all
   documents share gives right results, a rare-first one gives few candidates.
2. *Candidates.*  A second pass emits the rarest ``n - ceil(t n) + 1`` shingles of
   each set.  Sets that can reach the threshold share one of them.  Postings meet by
   shingle; pairs pass the length and the positional filter.
3. *Rounds.*  A posting list of m nodes first links each node to the list's
   smallest and to its neighbour only: 2m pairs, which joins true groups of near
   copies.  After components are known, only lists that still span several of them
   are expanded, between components: first each node's likeliest partner, then every
   pair that could still merge two components; none inside a component needs to be.
4. *Verification*, once per pair: the suffix filter bounds the overlap by the
   signature, what is left is decided on the whole texts.

Null or empty texts, and texts without words, have an empty set and link with
nothing.  A null id takes no part in links and has a null component.  Rows that
repeat an id and a text are one node.  Ties: a component's id is its smallest id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediafeat.llm import kernels as K
from mediafeat.llm.common import by_part, part_count, parted, scratch, text_of
from mediafeat.llm.components import components

U = np.uint64
TABLE_BITS = 20       # hashed document-frequency counters: 2**20, whatever the input
SLICES = 16           # the counter table travels in so many pieces
FILTER = 23           # a table of document ids has 2**23 bits
SIGNATURE = 256       # bins of a set's signature
FLUSH = 1 << 21       # postings a task gathers before it emits them
MOST = 1 << 16        # documents of a shingle from which on its list meets in several pieces
BLOCK = 1 << 13       # entries of a list from which on its pairs are formed by pairs of blocks
ROWS = 1 << 16        # entries a task gathers before it forms pairs
LIST = (1 << 48) - 1  # the bits of a meeting key that name the list


def _sets(data, bounds, n):
    """Sorted distinct shingle hashes of each document, document by document."""
    for i, j in K.runs(bounds):
        h, _, _, d = K.word_hashes(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
        sh, at = K.shingles(h, d, j - i, n)
        for k in range(j - i):
            u = np.sort(sh[at[k]:at[k + 1]])
            if len(u) > 1:
                u = u[np.concatenate([[True], u[1:] != u[:-1]])]
            yield i + k, u


def _fingerprint(u: np.ndarray) -> int:
    """A hash of the set: order-free, so equal sets have equal ones."""
    return int(K.mix(np.array([int(K.mix(u).sum()) & K.MASK], U) + U(len(u) * K.COEF[0] & K.MASK)).view(np.int64)[0])


def _needed(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return -(-num * n // den)


def profile(docs: DataFrame, n: int) -> DataFrame:
    """kind 0: doc_id, size, fp, sig of each document; kind 1: a task's counters."""
    def run(batches):
        import pyarrow as pa
        counts = np.zeros(1 << TABLE_BITS, np.int64)
        for batch in batches:
            data, bounds = K.texts(batch.column(1))
            size, fp, sig, seen = [], [], [], []
            for _, u in _sets(data, bounds, n):
                size.append(len(u))
                fp.append(_fingerprint(u) if len(u) else None)
                sig.append(np.minimum(np.bincount((u >> U(56)).astype(np.int64), minlength=SIGNATURE), 255).astype(np.uint8).tobytes())
                seen.append(u)
                if len(seen) == 2048:
                    counts += np.bincount((np.concatenate(seen) & U((1 << TABLE_BITS) - 1)).astype(np.int64), minlength=1 << TABLE_BITS)
                    seen = []
            if seen:
                counts += np.bincount((np.concatenate(seen) & U((1 << TABLE_BITS) - 1)).astype(np.int64), minlength=1 << TABLE_BITS)
            m = len(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * m, pa.int32()), batch.column(0), pa.array(size, pa.int64()), pa.array(fp, pa.int64()),
                 pa.array(sig, pa.binary()), pa.nulls(m, pa.int32())], ["kind", "doc_id", "size", "fp", "blob", "slice"])
        if counts.any():
            parts = np.split(counts, SLICES)
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * SLICES, pa.int32()), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()),
                 pa.nulls(SLICES, pa.int64()), pa.array([K.pack(p) for p in parts], pa.binary()),
                 pa.array(range(SLICES), pa.int32())], ["kind", "doc_id", "size", "fp", "blob", "slice"])
    return text_of(docs).mapInArrow(K.lean(run), "kind int, doc_id long, size long, fp long, blob binary, slice int")


def frequency_classes(counters: DataFrame) -> np.ndarray:
    """The rarity class (half powers of two) of every counter: 2**20 bytes."""
    def total(batches):
        import pyarrow as pa
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = K.unpack(blob)
                sums[s] = sums[s] + v if s in sums else v
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()),
                 pa.array([np.floor(2 * np.log2(v.astype(float) + 1)).astype(np.uint8).tobytes() for v in sums.values()], pa.binary())],
                ["slice", "classes"])
    rows = counters.select("slice", "blob").repartition(SLICES, "slice").mapInArrow(K.lean(total), "slice int, classes binary").collect()
    out = np.zeros(1 << TABLE_BITS, np.uint8)
    step = len(out) // SLICES
    for r in rows:
        out[r["slice"] * step:(r["slice"] + 1) * step] = np.frombuffer(r["classes"], np.uint8)
    return out


def _meeting_keys(u: np.ndarray, rarity: np.ndarray, fp: int, most: int) -> np.ndarray:
    """Where the postings of a set meet.  The low 48 bits name the list, the lowest
    one says whether it meets in pieces; then the top bits differ from piece to piece."""
    h = K.mix(u) & ~U(1)
    pieces = np.ceil(2.0 ** ((rarity.astype(float) + 1) / 2) / most).astype(U)     # of so many documents at most
    many = pieces > 1
    if many.any():
        piece = K.mix(h[many] ^ U(fp & K.MASK)) % pieces[many]
        h[many] = ((h[many] & U(LIST)) | (K.mix(h[many] + piece * U(K.COEF[2])) & ~U(LIST))) | U(1)
    return h


def postings(docs: DataFrame, classes, n: int, num: int, den: int, parts: int, most: int = MOST) -> DataFrame:
    """The rarest shingles of every set, as packed arrays per task and part."""
    def run(batches):
        import pyarrow as pa
        table, seen = classes.value, set()
        hs, fps, ns, ps, held = [], [], [], [], 0

        def emit():
            h, fp = np.concatenate(hs), np.concatenate(fps)
            size, pos = np.concatenate(ns), np.concatenate(ps)
            order = np.argsort(h)
            h, fp, size, pos = h[order], fp[order], size[order], pos[order]
            # the top bits choose the part, so parts are runs of the sorted array
            edge = np.searchsorted(h, np.array([(p << 64) // parts for p in range(parts)], U)).tolist() + [len(h)]
            rows = [(p, a, b) for p, (a, b) in enumerate(zip(edge, edge[1:])) if b > a]
            cols = [pa.array([p for p, _, _ in rows], pa.int32())]
            for values, ordered in ((h, True), (fp.view(U), False), (size, False), (pos, False)):
                cols.append(pa.array([K.pack(values[a:b], ordered) for _, a, b in rows], pa.binary()))
            return pa.RecordBatch.from_arrays(cols, ["part", "h", "fp", "size", "pos"])

        for batch in batches:
            data, bounds = K.texts(batch.column(1))
            for _, u in _sets(data, bounds, n):
                m = len(u)
                if not m or (fp := _fingerprint(u)) in seen:
                    continue
                seen.add(fp)
                first = m - (-(-num * m // den)) + 1
                rarity = table[(u & U((1 << TABLE_BITS) - 1)).astype(np.int64)]
                order = np.argsort(rarity, kind="stable")[:first]
                # meet by a mixed key: the parts are even whatever the hashes' order
                hs.append(_meeting_keys(u[order], rarity[order], fp, most))
                fps.append(np.full(first, fp, np.int64))
                ns.append(np.full(first, m, np.int64))
                ps.append(np.arange(first))
                held += first
                if held >= FLUSH:
                    yield emit()
                    hs, fps, ns, ps, held = [], [], [], [], 0
        if held:
            yield emit()
    return text_of(docs).where("doc_id is not null").mapInArrow(K.lean(run), "part int, h binary, fp binary, size binary, pos binary")


def _pass(na, nb, ia, ib, num, den):
    """The length and the positional filter."""
    need = -(-num * (na + nb) // (num + den))
    return ((np.minimum(na, nb) * den >= np.maximum(na, nb) * num)
            & (np.minimum(ia, ib) + 1 + np.minimum(na - ia - 1, nb - ib - 1) >= need))


def _unique_pairs(a, b):
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    keep = lo != hi
    lo, hi = lo[keep], hi[keep]
    order = np.lexsort((hi, lo))
    lo, hi = lo[order], hi[order]
    first = np.ones(len(lo), bool)
    first[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    return lo[first], hi[first]


def meet(posts: DataFrame, num: int, den: int, parts: int) -> DataFrame:
    """kind 0: pairs (a, b) of a list's smallest node and of neighbours with each
    node; kind 1: the lists of three nodes or more, and all pieces of lists, for the
    second round."""
    def run(batches):
        import pyarrow as pa
        cols: list[list] = [[], [], [], []]
        for batch in batches:
            for i in range(4):
                cols[i] += [K.unpack(x.as_py()) for x in batch.column(i + 1)]
        if not cols[0]:
            return
        h, fp, size, pos = (np.concatenate(c) for c in cols)
        cols.clear()
        fp, size, pos = fp.view(np.int64), size.astype(np.int64), pos.astype(np.int64)
        order = np.argsort(h, kind="stable")
        h, fp, size, pos = h[order], fp[order], size[order], pos[order]
        same = h[1:] == h[:-1]
        shared = (h & U(1)).astype(bool)
        shared[1:] |= same
        shared[:-1] |= same
        h, fp, size, pos = h[shared], fp[shared], size[shared], pos[shared]
        order = np.lexsort((fp, h))
        h, fp, size, pos = h[order], fp[order], size[order], pos[order]
        if not len(h):
            return
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (fp[1:] != fp[:-1])
        h, fp, size, pos = h[first], fp[first], size[first], pos[first]
        begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        count = np.diff(np.concatenate([begin, [len(h)]]))
        hub = np.repeat(begin, count)
        i = np.arange(len(h))
        left = np.concatenate([hub, i[1:] - 1])
        right = np.concatenate([i, i[1:]])
        ok = (left != right) & (h[left] == h[right])
        left, right = left[ok], right[ok]
        ok = _pass(size[left], size[right], pos[left], pos[right], num, den)
        a, b = _unique_pairs(fp[left[ok]], fp[right[ok]])
        names = ["kind", "a", "b", "h", "fps", "sizes", "spots"]
        for s in range(0, len(a), 1 << 16):
            x = slice(s, s + (1 << 16))
            m = len(a[x])
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(m, np.int32)), pa.array(a[x]), pa.array(b[x]), pa.nulls(m, pa.int64()),
                                              *[pa.nulls(m, pa.binary())] * 3], names)
        big = np.flatnonzero((count >= 3) | (h[begin] & U(1)).astype(bool))
        for s in range(0, len(big), 4096):
            rows = [(begin[k], begin[k] + count[k]) for k in big[s:s + 4096]]
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                 pa.array((np.array([h[x] for x, _ in rows], U) & U(LIST)).view(np.int64)),
                 *[pa.array([v[x:y].astype(np.int64).tobytes() for x, y in rows], pa.binary()) for v in (fp, size, pos)]], names)
    return by_part(posts, parts).mapInArrow(
        K.lean(run), "kind int, a long, b long, h long, fps binary, sizes binary, spots binary")


def _members(lists: DataFrame) -> DataFrame:
    """(h, fp, size, pos), one row per entry of a list."""
    def rows(batches):
        import pyarrow as pa
        for b in batches:
            n = np.array([len(x) // 8 for x in b.column(1).to_pylist()], np.int64)
            fp, size, pos = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.int64) for i in (1, 2, 3))
            h = np.repeat(b.column(0).to_numpy(zero_copy_only=False), n)
            for s in range(0, len(h), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[s:s + (1 << 16)]) for c in (h, fp, size, pos)], ["h", "fp", "size", "pos"])
    return lists.select("h", "fps", "sizes", "spots").mapInArrow(K.lean(rows), "h long, fp long, size long, pos long")


def _open_lists(members: DataFrame, comps: DataFrame, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """The entries of lists that span several components, with their ``root`` and
    the ``blocks`` of the list.  The strict positional filter allows a pair only if
    its ``excess`` values sum to 0 or less: an entry above that with the list's
    smallest can link with none in this list."""
    named = members.drop("root", "blocks").join(comps.select(F.col("node").alias("fp"), "root"), "fp", "left")
    named = scratch(named.withColumn("root", F.coalesce("root", "fp")), "lists")
    excess = (num + den) * F.col("pos") - (den - num) * F.col("size")
    several = (named.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(excess).alias("least"), F.count(F.lit(1)).alias("m"))
               .where("lo != hi and least <= 0").select("h", "least", F.ceil(F.col("m") / block).cast("int").alias("blocks")))
    return named.join(several, "h").where(excess + F.col("least") <= 0).drop("least")


def _units(open_lists: DataFrame) -> DataFrame:
    """Lists as units of work: short ones whole, of others every pair of blocks
    (``side`` 0: any two entries pair, else only those of different sides)."""
    own = F.pmod(F.xxhash64(F.lit(11), "fp"), F.col("blocks")).cast("int")
    rows = open_lists.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lower = F.least("own", "other")
    unit = F.when(F.col("blocks") == 1, F.col("h")).otherwise(F.xxhash64("h", lower, F.greatest("own", "other")))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") == lower, 1).otherwise(2)
    return rows.select(unit.alias("h"), "fp", "size", "pos", "root", side.alias("side"), "sig")


def _apart(sa: np.ndarray, sb: np.ndarray) -> np.ndarray:
    """A lower bound of the symmetric difference, from the signatures."""
    return np.abs(sa.astype(np.int16) - sb).sum(1)


def _apart_at(sig: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The same for pairs of rows of ``sig``, some thousands at a time."""
    out = np.empty(len(left), np.int64)
    for s in range(0, len(left), 1 << 13):
        x = slice(s, s + (1 << 13))
        out[x] = _apart(sig[left[x]], sig[right[x]])
    return out


def _across(open_lists: DataFrame, num: int, den: int, parts: int, nearest: bool) -> DataFrame:
    """Pairs (a, b) of one list and of two components that may link; with
    ``nearest`` only each node's likeliest partner in the list.  A pair that
    links has a first common shingle: all earlier ones differ, so its list is the
    one where the strict positional filter holds; the suffix filter comes at once."""
    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append([*(b.column(i).to_numpy(zero_copy_only=False) for i in range(6)),
                         np.frombuffer(b"".join(b.column(6).to_pylist()), np.uint8).reshape(-1, SIGNATURE)])
            n += b.num_rows
            if n < ROWS:
                continue
            cols = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.argmax(cols[0] == cols[0][-1]))      # units come one after the other: the last may go on
            held, n = [[c[cut:].copy() for c in cols]], n - cut
            if cut:
                yield from pairs([c[:cut] for c in cols])
        if n:
            yield from pairs([np.concatenate(c) for c in zip(*held)])

    def pairs(cols):
        import pyarrow as pa
        order = np.lexsort((cols[2], cols[0]))
        h, fp, size, pos, root, side, sig = (c[order] for c in cols)
        coarse = sig.reshape(len(sig), 32, -1).sum(2, dtype=np.int16)
        # sizes rise within a list: the length filter ends each row's range
        end = np.searchsorted(h, h, "right")
        span = np.full(len(h), 0, np.int64)
        for lo in np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])).tolist():
            i = slice(lo, end[lo])
            span[i] = lo + np.searchsorted(size[i], size[i] * den // num, "right") - np.arange(lo, end[lo]) - 1
        done = np.concatenate([[0], np.cumsum(span)])
        out = [np.zeros(0, np.int64)] * 2
        i = 0
        while i < len(h):
            k = max(i + 1, int(np.searchsorted(done, done[i] + (1 << 19), "right")) - 1)
            left = np.repeat(np.arange(i, k), span[i:k])
            right = left + 1 + np.arange(len(left)) - np.repeat(done[i:k] - done[i], span[i:k])
            i = k
            ok = (root[left] != root[right]) & ((side[left] == 0) | (side[left] != side[right]))
            left, right = left[ok], right[ok]
            na, nb, ia, ib = size[left], size[right], pos[left], pos[right]
            need = -(-num * (na + nb) // (num + den))
            ok = (1 + np.minimum(na - ia - 1, nb - ib - 1) >= need) & (ia + ib <= na + nb - 2 * need)
            left, right, room = left[ok], right[ok], (na + nb - 2 * need)[ok]
            ok = _apart_at(coarse, left, right) <= room
            left, right, room = left[ok], right[ok], room[ok]
            apart = _apart_at(sig, left, right)
            ok = apart <= room
            left, right, apart = left[ok], right[ok], apart[ok]
            if nearest:
                node, pair = np.concatenate([left, right]), np.tile(np.arange(len(left)), 2)
                order = np.lexsort((apart[pair], node))
                node, pair = node[order], np.unique(pair[order][np.concatenate([[True], node[order][1:] != node[order][:-1]])[:len(order)]])
                left, right = left[pair], right[pair]
            if len(left):
                out = _unique_pairs(np.concatenate([out[0], fp[left]]), np.concatenate([out[1], fp[right]]))
        if len(out[0]):
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], ["a", "b"])
    return _units(open_lists).repartition(parts, "h").sortWithinPartitions("h").mapInArrow(K.lean(run), "a long, b long")


def suffix_filter(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose signatures allow the overlap, with the documents to read."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            na, nb = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            sa, sb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, SIGNATURE) for i in (4, 5))
            need = -(-num * (na + nb) // (num + den))
            ok = (na + nb - _apart(sa, sb) >= 2 * need) & (np.minimum(na, nb) * den >= np.maximum(na, nb) * num)
            yield pa.RecordBatch.from_arrays([pc.filter(b.column(i), pa.array(ok)) for i in (0, 1, 6, 7)], ["a", "b", "doc_a", "doc_b"])
    x = nodes.select(F.col("fp").alias("a"), F.col("size").alias("na"), F.col("sig").alias("sa"), F.col("doc").alias("doc_a"))
    y = nodes.select(F.col("fp").alias("b"), F.col("size").alias("nb"), F.col("sig").alias("sb"), F.col("doc").alias("doc_b"))
    return (pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "sa", "sb", "doc_a", "doc_b")
            .mapInArrow(K.lean(run), "a long, b long, doc_a long, doc_b long"))


def verify(pairs: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole texts reach the threshold."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                b = batch.slice(s, 256)
                left = [u for _, u in _sets(*K.texts(b.column(2)), n)]
                right = [u for _, u in _sets(*K.texts(b.column(3)), n)]
                a_id, b_id, keep = b.column(0).to_pylist(), b.column(1).to_pylist(), []
                for k, (u, v) in enumerate(zip(left, right)):
                    if not len(u) or not len(v) or _fingerprint(u) != a_id[k] or _fingerprint(v) != b_id[k]:
                        continue          # another row of a repeated id
                    _, there = K.lookup(u, v)
                    both = int(there.sum())
                    if den * both >= num * (len(u) + len(v) - both):
                        keep.append(k)
                yield pa.RecordBatch.from_arrays([pa.array([a_id[k] for k in keep], pa.int64()), pa.array([b_id[k] for k in keep], pa.int64())],
                                                 ["a", "b"])
    texts = text_of(docs)
    x = texts.select(F.col("doc_id").alias("doc_a"), F.col("text").alias("text_a"))
    y = texts.select(F.col("doc_id").alias("doc_b"), F.col("text").alias("text_b"))
    return (pairs.join(x, "doc_a").join(y, "doc_b").select("a", "b", "text_a", "text_b")
            .mapInArrow(K.lean(run), "a long, b long").distinct())


def among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, text of the documents whose id may be one of ``ids`` (doc): a bit table of
    ids of fixed size, 2**``FILTER`` bits, spares most others the shuffles of a join."""
    size = (1 << FILTER) // 8 // SLICES

    def place(column):
        return (K.mix(column.to_numpy(zero_copy_only=False).view(U) + U(K.P)) >> U(64 - FILTER)).astype(np.int64)

    def mark(batches):
        import pyarrow as pa
        bits = np.zeros(1 << FILTER, bool)
        for b in batches:
            bits[place(b.column(0))] = True
        if bits.any():
            parts = np.packbits(bits).reshape(SLICES, size)
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([K.pack(p) for p in parts], pa.binary())], ["slice", "bits"])

    def union(batches):
        import pyarrow as pa
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found[k] = found.get(k, np.zeros(size, np.uint8)) | K.unpack(blob).astype(np.uint8)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())],
                                             ["slice", "bits"])
    kind = "slice int, bits binary"
    table = np.zeros((SLICES, size), np.uint8)
    rows = ids.select("doc").mapInArrow(K.lean(mark), kind).repartition(SLICES, "slice").mapInArrow(K.lean(union), kind).collect()
    for r in rows:
        table[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table.ravel())         # 2**FILTER bits

    def keep(batches):
        import pyarrow as pa
        bits = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            yield b.filter(pa.array(bits[place(b.column(0))]))
    return text_of(docs).where("doc_id is not null").mapInArrow(K.lean(keep), "doc_id long, text string")


def _linked(near: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The links among the pairs ``near``: of the texts only theirs are shuffled."""
    ends = near.select(F.explode(F.array("doc_a", "doc_b")).alias("doc"))
    return scratch(verify(near, scratch(among(docs, ends), "near-texts"), n, num, den), "links")


def link_classes(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: classes of documents whose
    ``n``-word shingle sets link at a Jaccard similarity of ``num / den`` or more."""
    spark = docs.sparkSession
    parts = part_count(docs)
    both = scratch(profile(docs, n), "profile")
    rows = both.where("kind = 0").select("doc_id", "size", "fp", F.col("blob").alias("sig"))
    nodes = scratch(rows.where("fp is not null and doc_id is not null").groupBy("fp").agg(
        F.min("doc_id").alias("doc"), F.first("size").alias("size"), F.first("sig").alias("sig")), "nodes")
    classes = spark.sparkContext.broadcast(frequency_classes(both.where("kind = 1")))     # 2**20 bytes
    met = scratch(meet(postings(docs, classes, n, num, den, parts, most), num, den, parts), "met")
    pairs = scratch(met.where("kind = 0").select("a", "b").distinct(), "pairs")
    near = scratch(suffix_filter(pairs, nodes, num, den), "near")
    links = _linked(near, docs, n, num, den)
    comps = components(links)
    lists = _open_lists(_members(met.where("kind = 1")), comps, num, den, block).join(nodes.select("fp", "sig"), "fp")
    for nearest in (True, False):       # likely partners first: they leave few components to compare
        lists = _open_lists(lists, comps, num, den, block)
        rest = _across(lists, num, den, parts, nearest).distinct().join(pairs, ["a", "b"], "left_anti")
        near = scratch(suffix_filter(rest, nodes, num, den), "near")
        if near.isEmpty():      # no new likely pair: others may still link
            continue
        more = _linked(near, docs, n, num, den)
        comps = components(comps.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
        pairs = pairs.union(near.select("a", "b"))
    comps = scratch(comps, "components")
    smallest = (nodes.select("fp", "doc").join(comps.select(F.col("node").alias("fp"), "root"), "fp")
                .groupBy("root").agg(F.min("doc").alias("component_id")))
    member = comps.join(smallest, "root").select(F.col("node").alias("fp"), "component_id")
    alone = nodes.select("fp", F.col("doc").alias("lowest"))
    return (rows.select("doc_id", "size", "fp").join(alone, "fp", "left").join(member, "fp", "left")
            .select("doc_id", F.col("size").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "lowest", "doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` (all columns) that are the smallest id of their class.  Rows
    that repeat an id and a text are one document, of which one row stays; rows that
    repeat an id with other texts are documents of their own, the first of a class by id,
    then by a hash of the text.  Rows with a null id all stay."""
    classes = scratch(link_classes(docs, n, num, den), "classes")
    if classes.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        gone = classes.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
        here, others = parted(docs, "doc_id", gone, "_gone")
        return here.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti").union(others)
    own = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))       # a repeated id names no document
    named = docs.where("doc_id is not null").withColumn("_own", own)
    ids = named.select("_own", F.col("doc_id").cast("long").alias("_id")).distinct()
    found = link_classes(named.select(F.col("_own").alias("doc_id"), "text").distinct(), n, num, den)
    found = scratch(found.select(F.col("doc_id").alias("_own"), "component_id").join(ids, "_own"), "own-classes")
    first = found.groupBy("component_id").agg(F.min(F.struct("_id", "_own")).alias("first")).select(F.col("first._own").alias("_first"))
    kept = named.dropDuplicates(["_own"]).join(first, F.col("_own") == F.col("_first"), "left_semi").drop("_own")
    return kept.union(docs.where("doc_id is null"))
