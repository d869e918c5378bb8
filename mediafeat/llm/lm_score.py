"""Language-model scores by deleted interpolation.

A word's probability mixes its maximum-likelihood estimate after the previous word,
its relative frequency, and a uniform share:

    p(w | v) = l2 c(v, w) / c(v) + l1 c(w) / N + l0 / (V + 1)

The weights depend on how often the context v was seen (buckets by powers of two;
bucket 0: never, where l2 is 0).  They are learned by expectation-maximisation on
held-out counts: every training token is scored with its own occurrence deleted
from all counts, so all training text serves both as counts and as held-out text.

How it runs.  Documents are dealt into blocks.  A block asks, once per distinct
token and token pair, for the counts over all training documents: its sorted 64-bit
hashes travel to the part that owns their key range, with the block's own counts.
The part adds up and answers each block.  A second exchange brings text and answers
together: first for the statistics of the estimation (a histogram of bounded size),
then for the scores.  A hot word is one entry per block, whatever its frequency.

Tokens: words (A-Z folded), then one end per document.  Null or empty texts have the
end alone.  A null id is scored but never learned from.  With no training tokens all
probability is uniform.  Repeated rows count as often as they occur.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediafeat.llm import kernels as K
from mediafeat.llm.common import by_part, fold, input_bytes, text_of

U = np.uint64
BUCKETS = 24          # of context counts: 0, 1, 2-3, 4-7, ...
GRID = 64             # steps of an estimate's logarithm in the estimation histogram
STEP = 0.5            # of a step, in natural logarithms
SLICES = 8            # the histogram travels in so many pieces
ROUNDS = 50           # of expectation-maximisation
BLOCK_BYTES = 4 << 20     # of input files that make a block
END, START = U(0x51ED270B76F9A4D3), U(0x2545F4914F6CDD1D)
REPLY = "blk long, part int, single binary, double binary, tokens long, kinds long"


def _tokens(data, bounds):
    """(token hashes with ends, hashes of (previous, token), documents' bounds)."""
    h, _, _, d = K.word_hashes(data, bounds)
    m = len(bounds) - 1
    count = np.bincount(d, minlength=m) + 1
    at = np.concatenate([[0], np.cumsum(count)])
    t = np.empty(at[-1], U)
    t[at[1:] - 1] = END
    body = np.ones(len(t), bool)
    body[at[1:] - 1] = False
    t[body] = h
    before = np.empty(len(t), U)
    before[1:] = t[:-1]
    before[at[:-1]] = START
    return t, before, K.mix(t + K.mix(before + U(K.COEF[0])) * U(K.COEF[1])), at


def _parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return np.searchsorted(keys, np.array([(p << 64) // parts for p in range(parts)], U)).tolist() + [len(keys)]


def _block(table):
    """A block's documents by number: bounds, distinct sorted tokens (with the start),
    each token's and each context's place among them, distinct sorted pairs and each
    pair's place."""
    data, bounds = K.texts(table.column("text"))
    ts, ps, ats = [np.zeros(0, U)], [np.zeros(0, U)], [np.zeros(1, np.int64)]
    for i, j in K.runs(bounds, 1 << 21):
        t, _, p, at = _tokens(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
        ts.append(t)
        ps.append(p)
        ats.append(at[1:] + ats[-1][-1])
    at = np.concatenate(ats)
    single, ti = np.unique(np.append(np.concatenate(ts), START), return_inverse=True)
    double, pi = np.unique(np.concatenate(ps), return_inverse=True)
    vi = np.empty(len(ti) - 1, ti.dtype)
    vi[1:] = ti[:-2]
    vi[at[:-1]] = ti[-1]
    return at, single, ti[:-1], vi, double, pi


def requests(blocks: DataFrame, parts: int) -> DataFrame:
    """What every block asks of every part: sorted keys and the block's counts."""
    def ask(table):
        import pyarrow as pa
        blk = table.column("blk")[0].as_py()
        cols = [[], [], [], [], []]
        at, s, ti, vi, d, pi = _block(table)
        train = table.column("train").to_numpy(zero_copy_only=False).astype(bool)
        on = np.repeat(train, np.diff(at))
        sc, dc = np.bincount(ti[on], minlength=len(s)), np.bincount(pi[on], minlength=len(d))
        sc[s == START] += int(train.sum())
        es, ed = _parts_of(s, parts), _parts_of(d, parts)
        for p in range(parts):
            a, b, x, y = es[p], es[p + 1], ed[p], ed[p + 1]
            if b > a or y > x:
                for c, v in zip(cols, (p, K.pack(s[a:b], True), K.pack(sc[a:b]), K.pack(d[x:y], True), K.pack(dc[x:y]))):
                    c.append(v)
        n = len(cols[0])
        return pa.Table.from_arrays([pa.array([blk] * n, pa.int64()), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                    ["blk", "part", "s", "sc", "d", "dc"])
    return blocks.groupBy("blk").applyInArrow(ask, "blk long, part int, s binary, sc binary, d binary, dc binary")


def _summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order].astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[begin], np.add.reduceat(c, begin) if len(begin) else c


def replies(asked: DataFrame, parts: int) -> DataFrame:
    """Every block's counts over all training text, in the order it asked.  Single
    and double counts of one part; the number of tokens and of distinct ones that
    the part holds go to the block's first row of it."""
    def answer(batches):
        import pyarrow as pa
        rows, got = [], [[], [], [], []]
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(6))):
                rows.append((r[0], r[1], r[2], r[4]))
                for i in range(4):
                    got[i].append(K.unpack(r[2 + i]))
        if not rows:
            return
        (s, sc), (d, dc) = _summed(got[0], got[1]), _summed(got[2], got[3])
        mine = s != START
        tokens, kinds = int(sc[mine].sum()), int((sc[mine] > 0).sum())
        for x, (blk, part, ks, kd) in enumerate(rows):
            at, _ = K.lookup(s, K.unpack(ks))
            to, _ = K.lookup(d, K.unpack(kd))
            yield pa.RecordBatch.from_arrays(
                [pa.array([blk], pa.int64()), pa.array([part], pa.int32()), pa.array([K.pack(sc[at] if len(s) else at)], pa.binary()),
                 pa.array([K.pack(dc[to] if len(d) else to)], pa.binary()), pa.array([tokens if x == 0 else 0], pa.int64()),
                 pa.array([kinds if x == 0 else 0], pa.int64())], ["blk", "part", "single", "double", "tokens", "kinds"])
    return (by_part(asked.select("blk", "part", "s", "sc", "d", "dc"), parts)
            .mapInArrow(K.lean(answer), REPLY))


def _bucket(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(c + 1.0)).astype(np.int64), BUCKETS - 1)


def _counted(table, reply):
    """(bounds, c(w), c(v), c(v, w)) of a block's tokens."""
    order = np.argsort(reply.column("part").to_numpy())
    single = [K.unpack(x) for x in np.array(reply.column("single").to_pylist(), object)[order]]
    double = [K.unpack(x) for x in np.array(reply.column("double").to_pylist(), object)[order]]
    at, _, ti, vi, _, pi = _block(table)
    sc, dc = (np.concatenate(x).astype(np.int64) for x in (single, double))
    return at, sc[ti], sc[vi], dc[pi]


def _estimates(cw, cv, cvw, n, v):
    with np.errstate(divide="ignore", invalid="ignore"):
        p2 = np.where(cv > 0, cvw / np.maximum(cv, 1), 0.0)
        p1 = cw / max(n, 1)
    return p2, p1, 1.0 / (v + 1)


def _numbers(reply) -> tuple[int, int]:
    return int(reply.column("n_all")[0].as_py()), int(reply.column("v_all")[0].as_py())


def histogram(blocks: DataFrame, answered: DataFrame) -> DataFrame:
    """Held-out statistics over all training tokens: how many fall in each cell of
    (context bucket, steps of p2 over uniform, steps of p1 over uniform), as packed
    arrays in SLICES rows."""
    names, schema = ["slice", "cell", "n"], "slice int, cell binary, n binary"

    def rows(kind, k, c):
        of = [k % SLICES == x for x in range(SLICES)]
        return kind.from_arrays([pa_ints(range(SLICES)), pa_blobs([K.pack(k[o], True) for o in of]), pa_blobs([K.pack(c[o]) for o in of])], names)

    def count(table, reply):
        import pyarrow as pa
        train = table.column("train").to_numpy(zero_copy_only=False).astype(bool)
        n, v = _numbers(reply)
        at, cw, cv, cvw = _counted(table, reply)
        on = np.repeat(train, np.diff(at))
        cw, cv, cvw = cw[on] - 1, cv[on] - 1, cvw[on] - 1       # the token itself deleted
        p2, p1, p0 = _estimates(cw, cv, cvw, n - 1, v)
        q2, q1 = (np.where(p > 0, np.clip(np.floor(np.log(np.maximum(p, 1e-300) / p0) / STEP) + 16, 1, GRID - 1), 0).astype(np.int64)
                  for p in (p2, p1))
        c = np.bincount((_bucket(cv) * GRID + q2) * GRID + q1, minlength=1)
        k = np.flatnonzero(c)
        return rows(pa.Table, k, c[k])

    def total(batches):
        import pyarrow as pa
        sums = np.zeros(BUCKETS * GRID * GRID, np.int64)
        for b in batches:
            for k, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                sums[K.unpack(k).astype(np.int64)] += K.unpack(c).astype(np.int64)
        k = np.flatnonzero(sums)
        if len(k):
            yield rows(pa.RecordBatch, k, sums[k])
    return (blocks.groupBy("blk").cogroup(answered.groupBy("blk")).applyInArrow(count, schema)
            .repartition(SLICES, "slice").mapInArrow(K.lean(total), schema))


def pa_ints(values):
    import pyarrow as pa
    return pa.array(list(values), pa.int32())


def pa_blobs(values):
    import pyarrow as pa
    return pa.array(values, pa.binary())


def mixture(cells: dict[int, int], rounds: int = ROUNDS) -> np.ndarray:
    """(BUCKETS, 3) weights of the pair, the single and the uniform estimate."""
    out = np.tile(np.array([0.0, 0.9, 0.1]), (BUCKETS, 1))
    if not cells:
        return out
    k = np.array(list(cells), np.int64)
    c = np.array([cells[x] for x in k.tolist()], float)
    bucket, q2, q1 = k // (GRID * GRID), k // GRID % GRID, k % GRID
    ratio = np.stack([np.where(q > 0, np.exp((q - 16 + 0.5) * STEP), 0.0) for q in (q2, q1)] + [np.ones(len(k))], 1)
    pooled = None
    for b in [None, *range(BUCKETS)]:
        on = np.ones(len(k), bool) if b is None else bucket == b
        w = np.full(3, 1 / 3) if pooled is None else pooled.copy()
        if b == 0:
            w[0] = 0.0
            w /= w.sum()
        if c[on].sum() < 1:
            out[b] = w
            continue
        for _ in range(rounds):
            share = ratio[on] * w
            w = (share / share.sum(1, keepdims=True) * c[on, None]).sum(0) / c[on].sum()
            w = (w + 1e-6) / (1 + 3e-6)
            if b == 0:
                w[0] = 0.0
                w /= w.sum()
        if b is None:
            pooled = w
        else:
            out[b] = w
    return out


def learned(cells: DataFrame) -> DataFrame:
    """The mixture weights as one row; a histogram has BUCKETS * GRID**2 cells at most."""
    def fit(batches):
        import pyarrow as pa
        found: dict[int, int] = {}
        for b in batches:
            for row in b.column(0).to_pylist():
                for x in row or []:
                    for k, n in zip(K.unpack(x["cell"]).tolist(), K.unpack(x["n"]).tolist()):
                        found[k] = found.get(k, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array([mixture(found).tobytes()], pa.binary())], ["weights"])
    return cells.agg(F.collect_list(F.struct("cell", "n")).alias("cells")).mapInArrow(K.lean(fit), "weights binary")


def scores(blocks: DataFrame, answered: DataFrame) -> DataFrame:
    def score(table, reply):
        import pyarrow as pa
        n, v = _numbers(reply)
        weights = np.frombuffer(reply.column("weights")[0].as_py()).reshape(BUCKETS, 3)
        at, cw, cv, cvw = _counted(table, reply)
        p2, p1, p0 = _estimates(cw, cv, cvw, n, v)
        w = weights[_bucket(cv)]
        p = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * p0)
        base = np.log10((cw + 0.5) / (n + 0.5 * (v + 1)))
        first = at[:-1]
        c = [np.diff(at), np.add.reduceat((cw > 0).astype(np.int64), first), np.add.reduceat(base, first), np.add.reduceat(p, first)]
        return pa.Table.from_arrays(
            [table.column("doc_id"), table.column("held_out"), pa.array(c[0].astype(np.int64)), pa.array(c[1].astype(np.int64)),
             pa.array(np.full(len(c[0]), n, np.int64)), pa.array(c[2].astype(float)), pa.array(c[3].astype(float))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return blocks.groupBy("blk").cogroup(answered.groupBy("blk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame, folds: int = 5, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every
    document, learning from those outside fold ``held_out``."""
    spark = docs.sparkSession
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_blocks = max(parts, input_bytes(docs) // BLOCK_BYTES)
    blocks = text_of(docs).select(
        "doc_id", "text", (fold("doc_id", folds) == held_out).alias("held_out"), F.col("doc_id").isNotNull().alias("known"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("blk"))
    blocks = blocks.select("blk", "doc_id", "text", "held_out", (F.col("known") & ~F.col("held_out")).alias("train"))
    # one plan: the exchanges of the blocks and of the questions are made once and
    # read by the answers, the estimation and the scores alike
    answered = replies(requests(blocks, parts), parts)
    counted = answered.withColumns({"n_all": answered.agg(F.coalesce(F.sum("tokens"), F.lit(0))).scalar(),
                                    "v_all": answered.agg(F.coalesce(F.sum("kinds"), F.lit(0))).scalar()})
    return scores(blocks, counted.withColumn("weights", learned(histogram(blocks, counted)).scalar()))
