"""Hard negatives from exact integer inner products.

1. *Tiles.*  Vectors become rows of integers, packed into tiles of up to ``ROWS`` rows
   where they lie (candidates) or after an even deal (anchors).  Anchor tiles and
   candidate tiles are dealt into groups of a few; a unit of work is one group of each,
   so its size is bounded whatever the input, and no table is broadcast.
2. *Products.*  A unit multiplies its tiles by Strassen's recursion on int64, halving
   all three sides (odd ones padded with zeros) down to ``LEAF``.  Sums and
   differences are exact in the ring of 64-bit integers, so only the product itself
   has to fit.
3. *Heaps.*  Each unit keeps per anchor its best rows of the same label, and Spark
   merges these heaps by anchor.  A second pass keeps, per anchor and positive, the
   best rows of other labels in the score window; they are merged the same way.

Rows with a null id, label or vector, or a null or non-finite component, take no part.
A shorter vector counts as padded with zeros, so an empty one scores 0.  Higher scores
come first, ties by smaller id.  Rows that repeat an id are rows of their own: an anchor
is never its own positive, but a repetition of it may be.  A product beyond ``MOST`` in
size would not fit the output and raises an error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediafeat.llm import kernels as K
from mediafeat.llm.common import scratch

ANCHORS, ROWS = 256, 1024            # rows of an anchor tile and of a candidate tile
ANCHOR_TILES, TILES = 4, 8           # expected tiles of a unit
LEAF = 32                            # a side from which on a product is not split
MOST = 1 << 56
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90                   # window of a negative's score, in percent of the positive's
TILE = "tile long, n int, item int, width int, ids binary, labels binary, x binary"
FAR = np.int64(1 << 62)


def relabelled(rows: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """id, label, x: every seventh id takes the next label of ten."""
    i, k = F.col(vec_id).cast("long"), F.col(label).cast("long")
    return rows.select(i.alias("id"), F.when(i % 7 == 0, (k + 1) % 10).otherwise(k).alias("label"), F.col(vector).cast("array<double>").alias("x"))


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, modulo 2**64."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    if n % 2 or k % 2:
        a = np.pad(a, ((0, n % 2), (0, k % 2)))
    if k % 2 or m % 2:
        b = np.pad(b, ((0, k % 2), (0, m % 2)))
    i, j, c = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :c], b[:j, c:], b[j:, :c], b[j:, c:]
    p1, p2 = strassen(a11 + a22, b11 + b22, leaf), strassen(a21 + a22, b11, leaf)
    p3, p4 = strassen(a11, b12 - b22, leaf), strassen(a22, b21 - b11, leaf)
    p5, p6, p7 = strassen(a11 + a12, b22, leaf), strassen(a21 - a11, b11 + b12, leaf), strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * c), np.int64)
    out[:i, :c], out[:i, c:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :c], out[i:, c:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:n, :m]


def _integers(batch):
    """(ids, labels, matrix) of the rows of a batch that take part."""
    ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    length = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)      # a null is NaN
    row = np.repeat(np.arange(len(ids)), length)
    with np.errstate(over="ignore"):
        values = np.floor(256 * values)
    kept = np.bincount(row[~np.isfinite(values)], minlength=len(ids)) == 0
    m = np.zeros((len(ids), max(1, int(length[kept].max(initial=0)))), np.int64)
    at = np.arange(len(values)) - np.repeat(np.cumsum(length) - length, length)
    inside = kept[row]
    if inside.any() and np.abs(values[inside]).max() > MOST:
        raise OverflowError("a component is too large for products of 64 bits")
    m[row[inside], at[inside]] = values[inside]
    return ids[kept].astype(np.int64), labels[kept].astype(np.int64), m[kept]


def tiles(rows: DataFrame, size: int) -> DataFrame:
    """Tiles of up to ``size`` rows, each sorted by id, of id, label, x."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def out(ids, labels, m):
            nonlocal number
            order = np.argsort(ids, kind="stable")
            top = int(np.abs(m).max(initial=0))
            item = next(s for s in (1, 2, 4, 8) if top < 1 << (8 * s - 1))
            cells = [number, len(ids), item, m.shape[1], ids[order].tobytes(), labels[order].tobytes(), m[order].astype(f"i{item}").tobytes()]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(
                cells, [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])],
                ["tile", "n", "item", "width", "ids", "labels", "x"])

        def joined():
            width = max(m.shape[1] for _, _, m in held)
            return (np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]),
                    np.concatenate([np.pad(h[2], ((0, 0), (0, width - h[2].shape[1]))) for h in held]))
        for batch in batches:
            for s in range(0, batch.num_rows, size):
                part = _integers(batch.slice(s, size))
                if not len(part[0]):
                    continue
                held.append(part)
                n += len(part[0])
                if n >= size:
                    ids, labels, m = joined()
                    yield out(ids[:size], labels[:size], m[:size])
                    held, n = ([(ids[size:], labels[size:], m[size:])] if n > size else []), n - size
        if n:
            yield out(*joined())
    return rows.select("id", "label", "x").mapInArrow(K.lean(run), TILE)


def _unpack(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64),
            np.frombuffer(r["x"], f"i{r['item']}").reshape(r["n"], r["width"]).astype(np.int64))


class Heaps:
    """The first ``keep`` (score, id) of every slot, merged as they come."""

    def __init__(self, slots: int, keep: int) -> None:
        self.keep, self.least = keep, np.full(slots, -FAR)
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        self.slot, self.score, self.id = slot[rank < self.keep], score[rank < self.keep], ids[rank < self.keep]
        last = rank == self.keep - 1
        self.least[slot[last]] = score[last]


class AnchorTile:
    """An anchor tile, the score windows of its slots and their heaps.  Without
    ``windows`` each anchor has one slot for rows of its label."""

    def __init__(self, r: dict, keep: int, windows: bool) -> None:
        self.tile, self.windows = r["tile"], windows
        self.ids, self.labels, self.x = _unpack(r)
        per = POSITIVES if windows else 1
        self.low, self.high = np.full((len(self.ids), per), -FAR), np.full((len(self.ids), per), FAR)
        if windows:
            self.low[:], self.high[:] = 1, 0                    # no positive: an empty window
            row, rank, p = (np.array(r[c], np.int64) for c in ("prow", "prank", "pscore"))
            self.low[row, rank - 1], self.high[row, rank - 1] = -(-LOW * p // 100), HIGH * p // 100
        self.own = (self.x * self.x).sum(1)
        self.heaps = Heaps(self.low.size, keep)

    def meet(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        width = max(self.x.shape[1], x.shape[1])
        a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (self.x, x))
        if width * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) > MOST:
            raise OverflowError("products of these vectors do not fit 64 bits")
        score = strassen(a, np.ascontiguousarray(b).T)
        match = (self.labels[:, None] == labels[None, :]) ^ self.windows
        per = self.low.shape[1]
        least = self.heaps.least.reshape(self.low.shape)
        begin, step = 0, 64
        while begin < len(ids):               # the first few rows tell what the others must reach
            c = slice(begin, begin + step)
            slots, scores, found = [], [], []
            for j in range(per):
                ok = match[:, c] & (score[:, c] >= np.maximum(self.low[:, j], least[:, j])[:, None]) & (score[:, c] <= self.high[:, j][:, None])
                row, col = np.nonzero(ok)
                slots.append(row * per + j)
                scores.append(score[:, c][row, col])
                found.append(ids[c][col])
            self.heaps.offer(np.concatenate(slots), np.concatenate(scores), np.concatenate(found))
            begin, step = begin + step, 4 * step

    def best(self):
        import pyarrow as pa
        per, h = self.low.shape[1], self.heaps
        row = h.slot // per
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(row), self.tile)), pa.array(row.astype(np.int32)), pa.array((h.slot % per + 1).astype(np.int32)),
             pa.array(self.ids[row]), pa.array(self.own[row]), pa.array(h.score), pa.array(h.id)],
            ["tile", "row", "slot", "anchor_id", "own", "score", "id"])


def best(anchors: DataFrame, candidates: DataFrame, groups: tuple[int, int], keep: int, windows: bool) -> DataFrame:
    """Per unit, anchor and slot the first ``keep`` rows: tile, row, slot, anchor_id,
    own (the anchor's product with itself), score, id."""
    def run(batches):
        unit, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if unit != (r["ag"], r["cg"]):
                    yield from (t.best() for t in held)
                    unit, held = (r["ag"], r["cg"]), []
                if r["anchor"]:
                    held.append(AnchorTile(r, keep, windows))
                elif held:
                    rows = _unpack(r)
                    for t in held:
                        t.meet(*rows)
        yield from (t.best() for t in held)

    def dealt(t: DataFrame, anchor: bool) -> DataFrame:
        own, other = ("ag", "cg") if anchor else ("cg", "ag")
        n_own, n_other = groups if anchor else groups[::-1]
        t = t.withColumn("anchor", F.lit(anchor)).withColumn(own, F.pmod(F.xxhash64("tile"), F.lit(n_own)).cast("int"))
        return t.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
    units = dealt(anchors, True).unionByName(dealt(candidates, False), allowMissingColumns=True)
    return (units.repartition(groups[0] * groups[1], "ag", "cg").sortWithinPartitions("ag", "cg", F.desc("anchor"), "tile")
            .mapInArrow(K.lean(run), "tile long, row int, slot int, anchor_id long, own long, score long, id long"))


def _first(heaps: DataFrame, keep: int) -> DataFrame:
    """The heaps of all units merged: the first ``keep`` of each slot, numbered ``k``."""
    order = Window.partitionBy("tile", "row", "slot").orderBy(F.desc("score"), "id")
    return heaps.withColumn("k", F.row_number().over(order)).where(F.col("k") <= keep)


def mine(rows: DataFrame, every: int = 100, size: tuple[int, int] = (ANCHORS, ROWS), per_unit: tuple[int, int] = (ANCHOR_TILES, TILES),
         is_anchor: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from
    rows of id, label, x.  Anchors are the ids divisible by ``every`` (or those of
    ``is_anchor``); each has up to ``POSITIVES`` positives, each of these up to
    ``NEGATIVES`` negatives."""
    rows = rows.where("id is not null and label is not null and x is not null")
    chosen = rows.where(F.col("id") % every == 0 if is_anchor is None else is_anchor)
    candidates = scratch(tiles(rows, size[1]), "candidate-tiles", wide=True)
    n = max(1, chosen.count())
    anchors = scratch(tiles(chosen.repartition(-(-n // (4 * size[0]))), size[0]), "anchor-tiles", wide=True)
    count = [t.agg(F.count(F.lit(1))).first()[0] for t in (anchors, candidates)]
    groups = tuple(max(1, -(-c // p)) for c, p in zip(count, per_unit))

    top = _first(best(anchors, candidates, groups, POSITIVES + 1, False), POSITIVES + 1)
    itself = F.when((F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("own")), F.col("k"))
    top = top.withColumn("me", F.min(itself).over(Window.partitionBy("tile", "row")))
    top = top.where("me is null or k <> me").withColumn("slot", F.col("k") - F.coalesce((F.col("k") > F.col("me")).cast("int"), F.lit(0)))
    positives = scratch(top.where(F.col("slot") <= POSITIVES).select(
        "tile", "row", "slot", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    packed = positives.groupBy("tile").agg(F.collect_list(F.struct("row", "slot", "positive_score")).alias("p")).select(     # of one tile
        "tile", F.col("p.row").alias("prow"), F.col("p.slot").alias("prank"), F.col("p.positive_score").alias("pscore"))
    found = _first(best(anchors.join(packed, "tile"), candidates, groups, NEGATIVES, True), NEGATIVES)
    return (found.select("tile", "row", "slot", "k", "id", "score").join(positives, ["tile", "row", "slot"])
            .select("anchor_id", "positive_id", F.col("k").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
