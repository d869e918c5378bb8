"""Suffix-array dedup: bytes covered by a long string that also starts earlier.

The index is a logarithmic family of sparse suffix arrays.  Suffixes are sampled by
content: every ``length``-byte string contains exactly one anchor, the position of
its smallest ``GRAM``-byte hash (the leftmost on ties), and equal strings choose the
same one.  A batch of documents sorts its anchors' suffixes by the hash of their
first bytes, then by the hash of all strings they stand for; the sorted run is cut
by key range among tasks.  There it is merge-scanned against the levels so far (of
two equal entries the earlier in (document, position) order stays, the other is a
repeat), becomes a level itself, and levels of like size merge geometrically.

Entries whose first bytes also occur with other surroundings may still share single
strings.  Exactly for those a second family is built, over the strings themselves.
Strings are compared by 64-bit hashes.

A long text is worked on in pieces that overlap by one string.  Null texts count as
empty, texts shorter than ``length`` keep all bytes.  Null ids come after all
others, as one id.  Rows that repeat an id and a text are one document (each row
gets its result); rows that repeat an id with other texts are documents in the
order of their texts' hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediafeat.llm import kernels as K
from mediafeat.llm.common import by_part, part_count, parted, scratch

U = np.uint64
LENGTH = 100          # bytes of a string that may not repeat
GRAM = 36             # bytes hashed to choose an anchor
PIECE = 1 << 20       # bytes handled at a time; longer texts in overlapping pieces
FLUSH = 3 << 17       # sampled suffixes in one sorted run
CROWD = 64            # surroundings of one gram in a run from which on it is not compared as a whole
LAST = (1 << 63) - 1  # stands for a null id
BLOB = "part int, key binary, ctx binary, kid binary, tag binary, lo binary, n binary"
MARK = "kid long, tag int, kind int, lo long, hi long"
NAMES = ["kid", "tag", "kind", "lo", "hi"]


def keyed(docs: DataFrame) -> DataFrame:
    """kid, tag, text: an id with one text has tag 0."""
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("kid"), F.coalesce("text", F.lit("")).alias("text"))
    ids = base.select("kid", F.xxhash64("text").alias("t"))
    twice = ids.groupBy("kid").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a != b").select("kid")
    if twice.isEmpty():
        return base.select("kid", F.lit(0).alias("tag"), "text")
    tags = ids.distinct().join(twice, "kid", "left_semi").select(
        "kid", "t", F.row_number().over(Window.partitionBy("kid").orderBy("t")).alias("tag"))
    return (base.withColumn("t", F.xxhash64("text")).join(scratch(tags, "tags"), ["kid", "t"], "left")
            .select("kid", F.coalesce("tag", F.lit(0)).alias("tag"), "text"))


def _pieces(data, bounds, length, piece):
    """(first document, last, bytes, bounds, offset in the first document)."""
    for i, j in K.runs(bounds, piece):
        a, b = int(bounds[i]), int(bounds[j])
        if b - a <= 2 * piece:
            yield i, j, data[a:b], bounds[i:j + 1] - a, 0
            continue
        for s in range(0, b - a - length + 1, piece):
            e = min(b - a, s + piece + length - 1)
            yield i, i + 1, data[a + s:a + e], np.array([0, e - s], np.int64), s


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """(key, surroundings, document, first string, strings) of each anchor in bytes
    of at most 2**21; strings are given by their start."""
    empty = tuple(np.zeros(0, t) for t in (U, U, np.int64, np.int64, np.int64))
    n = len(data)
    if n < length:
        return empty
    sums = K.range_sums(K.BYTE[data])
    _, down = K.powers(n + 1)
    h = K.mix((sums[gram:] - sums[:-gram]) * down[:n + 1 - gram])
    low = U((1 << 22) - 1)
    v = (h & ~low) | np.arange(len(h), dtype=U)
    span, width = length - gram + 1, 1      # the smallest of ``span`` values from each start
    m = v
    while 2 * width <= span:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < span:
        m = np.minimum(m[:len(m) - (span - width)], m[span - width:])
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(m)]
    start = np.flatnonzero(np.arange(len(m)) + length <= bounds[doc + 1])
    if not len(start):
        return empty
    at, doc = (m[start] & low).astype(np.int64), doc[start]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(start)]]))
    lo, at, doc = start[first], at[first], doc[first]
    ctx = K.mix(K.range_hash(sums, lo, lo + count - 1 + length) + (at - lo).astype(U) * U(K.COEF[1]))
    return h[at], ctx & U((1 << 48) - 1), doc, lo, count


def strings(data: np.ndarray, bounds: np.ndarray, doc: np.ndarray, lo: np.ndarray, n: np.ndarray, length: int):
    """The hash of every string lo .. lo + n - 1 of the given documents."""
    sums = K.range_sums(K.BYTE[data])
    which = np.repeat(np.arange(len(lo)), n)
    s = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return K.range_hash(sums, bounds[doc[which]] + s, bounds[doc[which]] + s + length), which, s


def _after(a, b):
    """Whether entries a come later than b, each as (kid, tag, lo)."""
    return (a[0] > b[0]) | ((a[0] == b[0]) & ((a[1] > b[1]) | ((a[1] == b[1]) & (a[2] > b[2]))))


def _rows(kind: int, e):
    import pyarrow as pa
    m = len(e["kid"])
    return pa.RecordBatch.from_arrays(
        [pa.array(e["kid"].astype(np.int64)), pa.array(e["tag"].astype(np.int32)), pa.array(np.full(m, kind, np.int32)),
         pa.array(e["lo"].astype(np.int64)), pa.array((e["lo"] + e["n"]).astype(np.int64))], NAMES)


def _take(e, i):
    return {k: v[i] for k, v in e.items()}


def _join(es):
    return {k: np.concatenate([e[k] for e in es]) for k in es[0]}


def _firsts(e):
    """One entry per full key, the earliest, sorted by that key; and the others."""
    order = np.lexsort((e["lo"], e["tag"], e["kid"], e["full"]))
    e = _take(e, order)
    new = np.ones(len(order), bool)
    new[1:] = e["full"][1:] != e["full"][:-1]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    same = (e["kid"] == e["kid"][lead]) & (e["tag"] == e["tag"][lead]) & (e["lo"] == e["lo"][lead])   # a repeated row
    return _take(e, new), _take(e, ~new & ~same)


class Family:
    """Levels of sorted entries; each new run is merge-scanned against all levels."""

    def __init__(self) -> None:
        self.levels: list[dict] = []

    def add(self, run: dict) -> dict:
        """Takes a run in; returns the entries found to be repeats."""
        run, late = _firsts(run)
        losers = [late]
        for level in self.levels:
            at, hit = K.lookup(level["full"], run["full"])
            if hit.any():
                i, j = np.flatnonzero(hit), at[hit]
                a, b = _take(run, i), _take(level, j)
                mine = [x[k] for x in (a,) for k in ("kid", "tag", "lo")]
                other = [x[k] for x in (b,) for k in ("kid", "tag", "lo")]
                losers.append(_take(a, _after(mine, other)))
                wins = _after(other, mine)
                losers.append(_take(b, wins))
                for k in ("kid", "tag", "lo"):
                    level[k][j[wins]] = a[k][wins]
                level["many"][j] |= a["many"]
                run = _take(run, ~hit)
        if len(run["full"]):
            self.levels.append(run)
        while len(self.levels) > 1 and len(self.levels[-2]["full"]) <= 2 * len(self.levels[-1]["full"]):
            both = _join(self.levels[-2:])
            self.levels[-2:] = [_take(both, np.argsort(both["full"], kind="stable"))]
        return _join(losers)


def _full(e):
    e["full"] = K.mix(e["key"] ^ K.mix(e["ctx"].copy()))
    return e


def _blobs(e, parts: int):
    """A sorted run cut by key range, packed; the lowest bit of ``n`` marks the entry
    that a crowded gram leaves in its run."""
    import pyarrow as pa
    e = _take(e, np.lexsort((e["ctx"], e["key"])))
    edge = np.searchsorted(e["key"], np.array([(p << 64) // parts for p in range(parts)], U)).tolist() + [len(e["key"])]
    rows = [(p, a, b) for p, (a, b) in enumerate(zip(edge, edge[1:])) if b > a]
    e["n"] = 2 * e["n"] + e["many"]
    cols = [pa.array([p for p, _, _ in rows], pa.int32())]
    for name in ("key", "ctx", "kid", "tag", "lo", "n"):
        cols.append(pa.array([K.pack(e[name][a:b].astype(np.int64).view(U) if name == "kid" else e[name][a:b], name == "key")
                              for _, a, b in rows], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, ["part", "key", "ctx", "kid", "tag", "lo", "n"])


OUT = f"kind int, {BLOB}, mkid long, mtag int, mlo long, mhi long"


def _emit(parts: int, runs_of, crowd: int | None):
    """A task's entries as packed runs (kind 0), with what the task knows already:
    repeats (kind 1) and entries to compare string by string (kind 2)."""
    import pyarrow as pa
    names = ["kind", "part", "key", "ctx", "kid", "tag", "lo", "n", "mkid", "mtag", "mlo", "mhi"]

    def runs(b):
        m = b.num_rows
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(m, np.int32)), *b.columns, pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()),
                                           pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names)

    def marks(kind, e):
        b = _rows(kind, e)
        m = b.num_rows
        return pa.RecordBatch.from_arrays([b.column(2), pa.array((K.mix(e["kid"].view(U) + U(K.P)) % U(parts)).astype(np.int32)), *[pa.nulls(m, pa.binary())] * 6,
                                           b.column(0), b.column(1), b.column(3), b.column(4)], names)

    def flush(entries):
        e, late = _firsts(_full(_join(entries)))
        yield marks(1, late)
        e["many"] = np.zeros(len(e["key"]), bool)
        if crowd:
            order = np.argsort(e["key"], kind="stable")
            e = _take(e, order)
            begin = np.flatnonzero(np.concatenate([[True], e["key"][1:] != e["key"][:-1]]))
            count = np.diff(np.concatenate([begin, [len(e["key"])]]))
            many = np.repeat(count > crowd, count)
            yield marks(2, _take(e, many))
            e["many"] = many.copy()
            many[begin] = False          # one entry of a crowded gram still tells the others
            e = _take(e, ~many)
        yield runs(_blobs(e, parts))

    entries, held = [], 0
    for e in runs_of:
        entries.append(e)
        held += len(e["key"])
        if held >= FLUSH:
            yield from flush(entries)
            entries, held = [], 0
    if held:
        yield from flush(entries)


def sampled(base: DataFrame, length: int, gram: int, parts: int, piece: int) -> DataFrame:
    """First family's runs over all documents."""
    def run(batches):
        def entries():
            for batch in batches:
                data, bounds = K.texts(batch.column(2))
                kid, tag = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                for i, _, d, b, shift in _pieces(data, bounds, length, piece):
                    key, ctx, doc, lo, n = anchors(d, b, length, gram)
                    if len(key):
                        yield {"key": K.mix(key), "ctx": ctx, "kid": kid[i + doc], "tag": tag[i + doc].astype(np.int64),
                               "lo": lo - b[doc] + shift, "n": n}
        yield from _emit(parts, entries(), CROWD)
    return base.select("kid", "tag", "text").mapInArrow(K.lean(run), OUT)


def scan(runs: DataFrame, parts: int, compare: bool) -> DataFrame:
    """The repeats (kind 1) among all runs and, with ``compare``, the entries whose
    first bytes occur with several surroundings or were crowded in a run (kind 2);
    what the tasks that made the runs knew already passes through."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        family = Family()
        for b in batches:
            known = b.filter(pc.not_equal(b.column(0), 0))
            if known.num_rows:
                yield pa.RecordBatch.from_arrays([known.column(8), known.column(9), known.column(0), known.column(10), known.column(11)], NAMES)
            b = b.filter(pc.equal(b.column(0), 0))
            for row in zip(*(b.column(i).to_pylist() for i in range(2, 8))):
                key, ctx, kid, tag, lo, n = (K.unpack(x) for x in row)
                yield _rows(1, family.add(_full({"key": key, "ctx": ctx, "kid": kid.view(np.int64), "tag": tag.astype(np.int64),
                                                 "lo": lo.astype(np.int64), "n": (n >> U(1)).astype(np.int64), "many": (n & U(1)).astype(bool)})))
        if compare and family.levels:
            e = _join(family.levels)
            e = _take(e, np.argsort(e["key"], kind="stable"))
            same = e["key"][1:] == e["key"][:-1]
            several = np.zeros(len(e["key"]), bool)
            several[1:] |= same
            several[:-1] |= same
            # the others of a crowded gram are compared string by string: so is what is left of it
            several |= np.isin(e["key"], e["key"][e["many"]])
            yield _rows(2, _take(e, several))
    return by_part(runs, parts).mapInArrow(K.lean(run), MARK)


def gathered(marks: DataFrame) -> DataFrame:
    """kid, tag, starts, ends: a document's marked strings as merged runs."""
    def run(batches):
        import pyarrow as pa
        cols = [[], [], [], []]
        for b in batches:
            for i in range(4):
                cols[i].append(b.column(i).to_numpy(zero_copy_only=False))
        if not cols[0]:
            return
        kid, tag, lo, hi = (np.concatenate(c).astype(np.int64) for c in cols)
        order = np.lexsort((lo, tag, kid))
        kid, tag, lo, hi = kid[order], tag[order], lo[order], hi[order]
        new = np.ones(len(kid), bool)
        new[1:] = (kid[1:] != kid[:-1]) | (tag[1:] != tag[:-1])
        doc = np.cumsum(new) - 1
        top = int(hi.max()) + 1 if len(hi) else 1
        reach = np.maximum.accumulate(doc * top + hi)
        cut = np.ones(len(kid), bool)
        cut[1:] = new[1:] | (doc[1:] * top + lo[1:] > reach[:-1])
        first = np.flatnonzero(cut)
        last = np.concatenate([first[1:], [len(kid)]]) - 1
        starts, ends, d = lo[first], reach[last] - doc[last] * top, doc[first]
        edge = np.searchsorted(d, np.arange(doc[-1] + 2)) if len(doc) else [0]
        at = np.flatnonzero(new)
        for s in range(0, len(at), 4096):
            k = range(s, min(s + 4096, len(at)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kid[at[s:s + 4096]]), pa.array(tag[at[s:s + 4096]].astype(np.int32)),
                 pa.array([starts[edge[x]:edge[x + 1]].tobytes() for x in k], pa.binary()),
                 pa.array([ends[edge[x]:edge[x + 1]].tobytes() for x in k], pa.binary())], ["kid", "tag", "starts", "ends"])
    return marks.select("kid", "tag", "lo", "hi").repartition("kid", "tag").mapInArrow(K.lean(run), "kid long, tag int, starts binary, ends binary")


def compared(base: DataFrame, doubtful: DataFrame, length: int, parts: int, piece: int) -> DataFrame:
    """Second family's runs: every string of the doubtful entries."""
    def run(batches):
        def entries():
            for batch in batches:
                data, bounds = K.texts(batch.column(2))
                kid, tag = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                blobs = [batch.column(i).to_pylist() for i in (3, 4)]
                for i, j, d, b, shift in _pieces(data, bounds, length, piece):
                    los, ns, docs = [], [], []
                    for k in range(i, j):
                        a, z = (np.frombuffer(x[k], np.int64) - shift for x in blobs)
                        a, z = np.maximum(a, 0), np.minimum(z, b[k - i + 1] - b[k - i] - length + 1)
                        ok = z > a
                        los.append(a[ok])
                        ns.append((z - a)[ok])
                        docs.append(np.full(int(ok.sum()), k - i))
                    lo, n, doc = np.concatenate(los), np.concatenate(ns), np.concatenate(docs)
                    if not len(lo):
                        continue
                    h, which, s = strings(d, b, doc, lo, n, length)
                    who = i + doc[which]
                    for x in range(0, len(h), FLUSH):
                        y = slice(x, x + FLUSH)
                        yield {"key": h[y], "ctx": np.zeros(len(h[y]), U), "kid": kid[who[y]], "tag": tag[who[y]].astype(np.int64),
                               "lo": s[y] + shift, "n": np.ones(len(h[y]), np.int64)}
        yield from _emit(parts, entries(), None)
    return base.join(doubtful, ["kid", "tag"]).select("kid", "tag", "text", "starts", "ends").mapInArrow(K.lean(run), OUT)


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(kid, tag, text) of every document, and (kid, tag, starts, ends) of those with
    repeats: runs [start, end) of starts of strings that also start earlier."""
    parts = part_count(docs)
    base = keyed(docs)
    found = scratch(scan(sampled(base, length, gram, parts, piece), parts, True), "repeats")
    doubtful = found.where("kind = 2")
    here, _ = parted(base, "kid", doubtful, "kid")       # of the texts only theirs are shuffled
    again = scan(compared(here, gathered(doubtful), length, parts, piece), parts, False)
    marks = found.where("kind = 1").union(again)
    return base, gathered(marks)


def _spans(starts: bytes | None, ends: bytes | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed byte runs."""
    if not starts:
        return []
    out: list[tuple[int, int]] = []
    for a, z in zip(np.frombuffer(starts, np.int64).tolist(), (np.frombuffer(ends, np.int64) + length - 1).tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, z in spans:
        out.append(text[at:a])
        at = z
    out.append(text[at:])
    return b"".join(out)


def report(docs: DataFrame, length: int = LENGTH, piece: int = PIECE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            data, bounds = K.texts(b.column(1))
            raw, rows = data.tobytes(), []
            for k, (doc, s, e) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())):
                text = raw[bounds[k]:bounds[k + 1]]
                spans = _spans(s, e, length)
                kept = _kept(text, spans)
                rows.append((None if doc == LAST else doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 4 + (pa.string(),))] if rows else
                                             [pa.array([], t) for t in (pa.int64(),) * 4 + (pa.string(),)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    base, marks = repeats(docs, length, piece=piece)
    marks = scratch(marks, "repeat-marks")
    here, others = parted(base, "kid", marks, "kid")
    rows = here.join(marks, ["kid", "tag"], "left").unionByName(others, allowMissingColumns=True)
    return rows.select("kid", "text", "starts", "ends").mapInArrow(
        K.lean(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _whole_chars(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole UTF-8 characters."""
    out = []
    for a, z in spans:
        while a < z and text[a] & 0xC0 == 0x80:
            a += 1
        while z > a and z < len(text) and text[z] & 0xC0 == 0x80:
            z -= 1
        if a < z:
            out.append((a, z))
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every column of ``docs``; texts without their repeats (whole characters only),
    ``n_chars`` with them if there is one.  Documents that lose all words go."""
    cols = docs.columns

    def run(batches):
        import pyarrow as pa
        for b in batches:
            data, bounds = K.texts(b.column(0))
            raw, out, keep = data.tobytes(), [], []
            for k, (s, e) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                text = raw[bounds[k]:bounds[k + 1]]
                kept = _kept(text, _whole_chars(text, _spans(s, e, length)))
                keep.append(len(kept) == len(text) or bool(kept.split()))
                out.append(kept.decode("utf-8", "replace"))
            mask = pa.array(keep, pa.bool_())
            rest = [b.column(i).filter(mask) for i in range(3, b.num_columns)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()).filter(mask), *rest], ["_clean", *b.schema.names[3:]])

    base, marks = repeats(docs, length)
    marked = scratch(base.select("kid", "tag", F.xxhash64("text").alias("_t")).distinct().join(marks, ["kid", "tag"]).select(
        F.col("kid").alias("_kid"), "_t", F.col("starts").alias("_s"), F.col("ends").alias("_e")), "repeat-marks")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_kid"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    here, others = parted(rows, "_kid", marked, "_kid")
    joined = here.join(marked, ["_kid", "_t"], "left").select(F.col("_row.text").alias("_x"), "_s", "_e", "_row")
    clean = joined.where("_s is not null").mapInArrow(K.lean(run), T.StructType([T.StructField("_clean", T.StringType()), rows.schema["_row"]]))
    new = {"text": F.col("_clean")} | ({"n_chars": F.length("_clean").cast(docs.schema["n_chars"].dataType)} if "n_chars" in cols else {})
    return others.select("_row.*").unionByName(joined.where("_s is null").select("_row.*")).unionByName(
        clean.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in cols]))
