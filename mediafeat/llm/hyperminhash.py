"""MinHash near-duplicate classes with HyperMinHash registers.

1. *Registers.*  A set's shingle hashes fall into ``REGISTERS`` buckets by their top
   bits.  A bucket's smallest hash is kept in two bytes: its number of leading zeros and
   the ``MANTISSA`` bits after the first one.  An empty bucket takes the register of
   the first filled one in a fixed random order of its own, so that short texts also
   have all registers and any register of two sets agrees with probability J (and a
   little more by chance).  Equal sets collapse to one node first.
2. *Bands.*  ``BANDS`` runs of ``ROWS`` compressed registers are hashed; nodes that
   agree in one share a bucket.  At a Jaccard similarity of 0.8 a pair shares no
   bucket of 32 bands of 4 with a probability of 5e-8.
3. *Rounds.*  Every member of a bucket is compared with the one of the smallest id.
   Once components are known, only buckets that still span several go on: the members
   outside the largest component meet all others, by blocks of ``BLOCK`` on either
   side, a block against a block being one task's unit.  Buckets that would take more
   than ``WORK`` comparisons are first cut by the agreement in a further band (any
   later one; a linking pair has about 13 of them) and take the next round; those that
   have no band left are compared as they are.  No list of members is ever gathered.
4. *Estimate, then verification.*  The share of agreeing registers, corrected for
   the chance agreements expected of sets of these sizes, estimates J; pairs six
   standard deviations below the threshold go.  The rest is decided on the full sets
   of the whole texts.

Null or empty texts, and texts without words, have an empty set and link with
nothing.  A null id takes no part in links, its component is null, and it is kept.
Rows that repeat an id and a text are one node; a component's id is its smallest id.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediafeat.llm import kernels as K
from mediafeat.llm.common import scratch, text_of
from mediafeat.llm.components import components
from mediafeat.llm.jaccard_join import _fingerprint, _sets, among, verify

U = np.uint64
REGISTERS = 128
TOP = 7                  # bits of a hash that choose the register
MANTISSA = 10            # bits kept after the first one
BANDS, ROWS = 32, 4
WORK = 1 << 22           # comparisons in a bucket from which on it is cut by a further band
BLOCK = 512              # members of either side of a unit
SIGMAS = 6               # standard deviations that an estimate may fall short


@functools.lru_cache(maxsize=1)
def _detours() -> np.ndarray:
    """For each register the order in which an empty one looks for a filled one."""
    rank = K.mix(np.arange(REGISTERS * REGISTERS, dtype=U) * U(K.P) + U(13)).reshape(REGISTERS, REGISTERS)
    rank[np.arange(REGISTERS), np.arange(REGISTERS)] = 0
    return np.argsort(rank, axis=1)


def _compressed(low: np.ndarray) -> np.ndarray:
    """Leading zeros (of the bits below the bucket's) and mantissa of smallest hashes."""
    bits = 64 - TOP
    short = (low >> U(bits - 53)).astype(np.float64)              # 53 bits: exact as a double
    length = np.frexp(short)[1].astype(np.int64)                  # 0 for a zero
    zeros = np.minimum(53 - length, 53)
    mantissa = ((low << (zeros + 1).astype(U)) >> U(bits - MANTISSA)) & U((1 << MANTISSA) - 1)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, REGISTERS) of sorted hash sets that aren't empty."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    full = np.zeros((len(sets), REGISTERS), bool)
    for k, u in enumerate(sets):
        bucket = (u >> U(64 - TOP)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))    # sorted: a bucket's smallest
        out[k, bucket[first]] = _compressed(u[first] & U((1 << (64 - TOP)) - 1))
        full[k, bucket[first]] = True
    own, order = out.copy(), _detours()
    open_ = ~full
    for t in range(1, REGISTERS):
        if not open_.any():
            break
        take = open_ & full[:, order[:, t]]
        out[take] = own[:, order[:, t]][take]
        open_ &= ~take
    return out


@functools.lru_cache(maxsize=4096)
def _cells(step: int) -> np.ndarray:
    """How the smallest of 2**(step/4) hashes falls on the values of a register."""
    zeros, j = np.arange(54.0)[:, None], np.arange(1 << MANTISSA)[None, :]
    low = 0.5 ** (zeros + 1) * (1 + j / (1 << MANTISSA))
    high = 0.5 ** (zeros + 1) * (1 + (j + 1) / (1 << MANTISSA))
    k = 2.0 ** (step / 4)
    return ((1 - low) ** k - (1 - high) ** k).ravel()


@functools.lru_cache(maxsize=1 << 16)
def _chance(a: int, b: int) -> float:
    return float(_cells(a) @ _cells(b))


def estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers and set sizes, without chance agreements."""
    agree = (ra == rb).mean(axis=1)
    step = [np.round(4 * np.log2(np.maximum(n / REGISTERS, 1))).astype(int).tolist() for n in (na, nb)]
    chance = np.array([_chance(min(x), max(x)) for x in zip(*step)])
    return (agree - chance) / (1 - chance)


def profile(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, size, fp (a fingerprint of the set), regs of each document."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            size, fp, regs, held = [], [], [], []
            for _, u in _sets(*K.texts(batch.column(1)), n):
                size.append(len(u))
                fp.append(_fingerprint(u) if len(u) else None)
                held.append(u)
                if len(held) == 512:
                    regs += _blobs(held)
                    held = []
            regs += _blobs(held)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(fp, pa.int64()), pa.array(regs, pa.binary())],
                                             ["doc_id", "size", "fp", "regs"])
    return text_of(docs).mapInArrow(K.lean(run), "doc_id long, size long, fp long, regs binary")


def _blobs(sets: list[np.ndarray]) -> list[bytes | None]:
    rows = iter(registers([u for u in sets if len(u)]))
    return [next(rows).tobytes() if len(u) else None for u in sets]


def _band_key(regs, band, *more):
    return F.xxhash64(*more, band, F.substring(regs, band * (2 * ROWS) + 1, F.lit(2 * ROWS)))


def band_members(nodes: DataFrame) -> DataFrame:
    """(key, fp, doc, band): a row for each node and band."""
    return (nodes.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))))
            .select(_band_key(F.col("regs"), F.col("band")).alias("key"), "fp", "doc", "band"))


def _cut(heavy: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members (key, fp, doc, band) of large buckets by their agreement in a later band."""
    return (heavy.join(nodes.select("fp", "regs"), "fp").withColumn("band", F.explode(F.sequence(F.col("band") + 1, F.lit(BANDS - 1))))
            .select(_band_key(F.col("regs"), F.col("band"), F.col("key")).alias("key"), "fp", "doc", "band"))


def _open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of buckets in which some pair across components may not have been
    compared, with their ``root``, whether they are ``out`` of the bucket's largest
    component, the bucket's members ``n`` and how many of them are out, ``n_out``."""
    named = members.join(comps.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    per = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    # of two members one is the hub: compared
    span = (per.groupBy("key").agg(F.sum("c").alias("n"), F.max(F.struct("c", "root")).alias("main"))
            .where("n > 2 and main.c < n").select("key", "n", F.col("main.root").alias("main"), (F.col("n") - F.col("main.c")).alias("n_out")))
    return named.join(span, "key").select("key", "fp", "doc", "band", "root", "n", "n_out", (F.col("root") != F.col("main")).alias("out"))


def _units(open_: DataFrame, block: int) -> DataFrame:
    """Every block of a bucket's outsiders (``side`` 0) with every block of its members
    (``side`` 1): unit, side, out, fp, root, doc."""
    outs, alls = (F.greatest(F.ceil(F.col(c) / block), F.lit(1)).cast("int") for c in ("n_out", "n"))

    def dealt(rows, side, own, other):
        at = F.pmod(F.xxhash64(F.lit(17), "fp"), own).cast("int")
        rows = rows.withColumn("there", F.explode(F.sequence(F.lit(0), other - 1))).withColumn("here", at)
        pair = ("here", "there") if side == 0 else ("there", "here")
        return rows.select(F.xxhash64("key", *pair).alias("unit"), F.lit(side).alias("side"), "out", "fp", "root", "doc")
    return dealt(open_.where("out"), 0, outs, alls).union(dealt(open_, 1, alls, outs))


def _by_unit(batches):
    """The rows of one unit after the other, as tables."""
    import pyarrow as pa
    held, now = [], None
    for b in batches:
        unit = b.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist(), len(unit)]
        for s, e in zip(cuts, cuts[1:]):
            if e == s:
                continue
            if held and unit[s] != now:
                yield pa.Table.from_batches(held)
                held = []
            now = unit[s]
            held.append(b.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def _sides(t):
    """(outsiders, members): positions in the table, fingerprints, roots, outsiders or not."""
    side, out, fp, root = (t.column(i).to_numpy() for i in (1, 2, 3, 4))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return left, right, fp, root, out.astype(bool)


def _may_pair(i, right, fp, root, out):
    """Members that outsider ``i`` is compared with: of another component, and two
    outsiders once."""
    return (root[right] != root[i]) & (~out[right] | (fp[i] < fp[right]))


def likely(units: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of ``units`` that have a partner in theirs by the estimate."""
    floor = _floor(num, den)

    def run(batches):
        import pyarrow as pa
        for t in _by_unit(batches):
            left, right, fp, root, out = _sides(t)
            size = t.column("size").to_numpy()
            regs = np.frombuffer(b"".join(t.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            keep = np.zeros(t.num_rows, bool)
            for i in left.tolist():
                at = right[_may_pair(i, right, fp, root, out)]
                at = at[np.minimum(size[at], size[i]) * den >= np.maximum(size[at], size[i]) * num]
                if len(at):
                    near = at[estimate(regs[at], regs[i][None], size[at], np.full(len(at), size[i])) >= floor]
                    keep[near] = True
                    keep[i] |= len(near) > 0
            if keep.any():
                yield from t.select(["unit", "side", "out", "fp", "root", "doc"]).filter(pa.array(keep)).to_batches()
    rows = units.join(nodes.select("fp", "size", "regs"), "fp").select("unit", "side", "out", "fp", "root", "doc", "size", "regs")
    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(
        K.lean(run), "unit long, side int, out boolean, fp long, root long, doc long")


def confirmed(units: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between the outsiders and the members of units, on the full sets of
    the whole texts."""
    def run(batches):
        import pyarrow as pa
        for t in _by_unit(batches):
            left, right, fp, root, out = _sides(t)
            sets = [u for _, u in _sets(*K.texts(t.column("text")), n)]
            sound = np.array([bool(len(u)) and _fingerprint(u) == f for u, f in zip(sets, fp.tolist())])      # else another row of a repeated id
            left, right = left[sound[left]], right[sound[right]]
            if not len(left) or not len(right):
                continue
            size = np.array([len(u) for u in sets])
            place = np.unique(np.concatenate([sets[i] for i in right.tolist()]), return_inverse=True)
            known, at = place[0], place[1]
            begin = np.cumsum(size[right]) - size[right]
            a, b = [], []
            for i in left.tolist():
                where, there = K.lookup(known, sets[i])
                mark = np.zeros(len(known), np.int64)
                mark[where[there]] = 1
                both = np.add.reduceat(mark[at], begin)
                ok = right[_may_pair(i, right, fp, root, out) & (den * both >= num * (size[right] + size[i] - both))]
                a += [int(fp[i])] * len(ok)
                b += fp[ok].tolist()
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    texts = text_of(docs).select(F.col("doc_id").alias("doc"), "text")
    rows = units.join(texts, "doc").select("unit", "side", "out", "fp", "root", "text")
    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(K.lean(run), "a long, b long")


def _floor(num: int, den: int) -> float:
    t = num / den
    return t - SIGMAS * (t * (1 - t) / REGISTERS) ** 0.5


def candidates(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, doc_a, doc_b) of pairs whose estimate does not rule the threshold out."""
    floor = _floor(num, den)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            for s in range(0, batch.num_rows, 8192):
                b = batch.slice(s, 8192)
                na, nb = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
                ra, rb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5))
                ok = (np.minimum(na, nb) * den >= np.maximum(na, nb) * num) & (estimate(ra, rb, na, nb) >= floor)
                yield pa.RecordBatch.from_arrays([pc.filter(b.column(i), pa.array(ok)) for i in (0, 1, 6, 7)], ["a", "b", "doc_a", "doc_b"])
    x, y = (nodes.select(F.col("fp").alias(s), F.col("size").alias(f"n{s}"), F.col("regs").alias(f"r{s}"), F.col("doc").alias(f"doc_{s}"))
            for s in "ab")
    return (pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "ra", "rb", "doc_a", "doc_b")
            .mapInArrow(K.lean(run), "a long, b long, doc_a long, doc_b long"))


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def classes(docs: DataFrame, n: int = 4, num: int = 80, den: int = 100, work: int = WORK, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row: documents whose ``n``-word
    shingle sets link at a Jaccard similarity of ``num / den`` or more."""
    rows = scratch(profile(docs, n), "registers")
    nodes = scratch(rows.where("fp is not null and doc_id is not null").groupBy("fp").agg(
        F.min("doc_id").alias("doc"), F.first("size").alias("size"), F.first("regs").alias("regs")), "register-nodes")
    comps = nodes.sparkSession.createDataFrame([], "node long, root long")
    tested = nodes.sparkSession.createDataFrame([], "a long, b long")

    def linked(more: DataFrame) -> DataFrame:
        return scratch(components(comps.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)), "register-components")

    members = band_members(nodes)
    while True:
        members = scratch(members, "bands")
        hubs = members.groupBy("key").agg(F.min(F.struct("doc", "fp")).alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
        pairs = members.join(hubs.select("key", F.col("hub.fp").alias("hub")), "key").where("fp <> hub").select(
            F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")).distinct()
        near = scratch(candidates(pairs.join(tested, ["a", "b"], "left_anti"), nodes, num, den), "register-near")
        ends = near.select(F.col("doc_a").alias("doc")).union(near.select("doc_b"))
        comps = linked(verify(near, scratch(among(docs, ends), "register-texts"), n, num, den))
        tested = tested.union(near.select("a", "b"))
        open_ = scratch(_open(members, comps), "open-bands")
        direct = (F.col("n") * F.col("n_out") <= work) | (F.col("band") == BANDS - 1)
        found = scratch(likely(_units(open_.where(direct), block), nodes, num, den), "register-units")
        comps = linked(confirmed(found, among(docs, found.select("doc")), n, num, den))
        heavy = open_.where(~direct)
        if heavy.isEmpty():
            break
        members = _cut(heavy, nodes)
    smallest = (nodes.select("fp", "doc").join(comps.select(F.col("node").alias("fp"), "root"), "fp")
                .groupBy("root").agg(F.min("doc").alias("component_id")))
    named = comps.join(smallest, "root").select(F.col("node").alias("fp"), "component_id")
    named = nodes.select("fp", F.col("doc").alias("lowest")).join(named, "fp", "left")
    return (rows.select("doc_id", "size", "fp").join(named, "fp", "left")
            .select("doc_id", F.col("size").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "lowest", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
