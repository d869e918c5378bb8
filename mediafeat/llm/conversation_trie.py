"""Prefix trie of conversations.

1. *Turns.*  A turn is known by a 128-bit digest of its role and text; a dictionary gives
   each distinct one a number.  Positions within a conversation are numbered by blocks,
   so that one with a third of all rows is no single task's work.
2. *Private ends.*  From the first (position, turn) that occurs once in the whole table,
   a conversation runs alone: those nodes follow from its rows without a trie.  Only
   what comes before is gathered, as one array a conversation; equal ones collapse.
3. *Range shards.*  The distinct sequences, in lexicographic order, are cut into ranges.
   A shard inserts its sequences, median first, into a ternary search tree of turn
   numbers, and an iterative traversal sums members, leaves and savings upwards.
   A prefix can reach beyond a shard only if it lies on the path of its first or last
   sequence: these boundary nodes leave open, all others are final.
4. *Boundary merging.*  Boundary nodes of ``FAN`` neighbouring shards meet, what lies
   inside is summed and final, and the next level merges what still lies at the rim,
   until the root is reached.

The ids of conversations that end at a node are hashed as a stream of sorted pieces, so
that no list of ids is held; the hash itself is serial by nature.

Rows with a null conversation take no part.  Rows of one conversation and turn are
ordered by their digest.  Null roles and texts count as empty.  An empty table has no
node.  Digests stand for texts: two different ones are taken as equal with a
probability of about 1e-18 among 1e10.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediafeat.llm import kernels as K
from mediafeat.llm.common import WORD, scratch
from mediafeat.operators.ordering import number_rows

SHARD = 1 << 15          # expected turns of distinct sequences in a shard
FAN = 64                 # shards whose boundary nodes one task merges
PIECE = 1 << 16          # characters of ids in a piece
NONE = hashlib.sha256(b"").hexdigest()
NODES = ("kind int, shard long, side int, key string, parent_key string, conv_id long, depth int, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved long, n_end long, words long")
NAMES = [c.split()[0] for c in NODES.split(", ")]


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, what, words: every turn by its place and its digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    what = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", what.alias("what"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return number_rows(rows, ["conv_id"], ["turn", "what"], "pos").drop("turn")


def rebuilt(conversations: DataFrame, block: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) and (conv_id, pos, what, words) of conversations that start
    with the first crc32(id) % ``heads`` turns of the first of their ``block``."""
    own = scratch(_turns(conversations), "turns")
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    c = F.col("conv_id")
    convs = convs.withColumn("base", c - c % block).withColumn("h", F.crc32(c.cast("string")) % heads)
    first = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = scratch(convs.join(first, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0)))), "conversations")
    lent = (own.where((c % block == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "base")
            .join(convs.select("conv_id", "base", "h"), "base").where("pos <= h").select("conv_id", "pos", "what", "words"))
    kept = (own.join(convs.select("conv_id", "h", "lent"), "conv_id").where("pos > h")
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("lent")).cast("int").alias("pos"), "what", "words"))
    return (convs.select("conv_id", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
            scratch(lent.union(kept), "rebuilt"))


class Tree:
    """A ternary search tree; node 0 is the root, ``eq`` leads to the next turn."""

    def __init__(self) -> None:
        self.sym, self.lo, self.hi, self.eq, self.parent, self.depth, self.words = [-1], [0], [0], [0], [-1], [0], [0]

    def _new(self, sym: int, parent: int, words: int) -> int:
        for column, value in ((self.sym, sym), (self.lo, 0), (self.hi, 0), (self.eq, 0), (self.parent, parent),
                              (self.depth, self.depth[parent] + 1), (self.words, words)):
            column.append(value)
        return len(self.sym) - 1

    def insert(self, turns: list[int], words: list[int]) -> list[int]:
        """The nodes of a sequence from the root on."""
        path = [0]
        for s, w in zip(turns, words):
            node, link, at = path[-1], self.eq, path[-1]
            t = link[at]
            while t and self.sym[t] != s:
                link, at = (self.lo, t) if s < self.sym[t] else (self.hi, t)
                t = link[at]
            if not t:
                t = self._new(s, node, w)
                link[at] = t
            path.append(t)
        return path

    def upwards(self) -> list[int]:
        """All nodes, each after those below it."""
        order, stack = [], [0]
        while stack:
            t = stack.pop()
            order.append(t)
            stack += [x for x in (self.lo[t], self.eq[t], self.hi[t]) if x]
        return order[::-1]


def _medians(n: int):
    """0..n-1, the middle of every range before its halves."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            stack += [(m + 1, b), (a, m)]


def _path_keys(turns: list[int]) -> list[str]:
    h = hashlib.md5(usedforsecurity=False)
    out = [h.hexdigest()]
    for i, t in enumerate(turns):
        h.update(f",{t}".encode() if i else str(t).encode())
        out.append(h.hexdigest())
    return out


def _batches(rows, size: int = 1 << 14):
    import pyarrow as pa
    kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in NODES.split(", ")]
    for s in range(0, len(rows), size):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[s:s + size]), kinds)], NAMES)


def _grow(batches):
    """The nodes of one shard: kind 0 final, kind 1 on its boundary."""
    from pyspark import TaskContext
    shard, seqs = TaskContext.get().partitionId(), []
    for b in batches:
        seqs += zip(*(b.column(i).to_pylist() for i in range(6)))      # turns, words, key, n_end, n_on, low
    if not seqs:
        return
    tree, ends, paths = Tree(), {}, {}
    for m in _medians(len(seqs)):
        path = tree.insert(seqs[m][0], seqs[m][1])
        ends[path[-1]] = seqs[m][2:]
        if m in (0, len(seqs) - 1):
            paths[m] = path
    key, side = {}, {}
    for m, bit in ((0, 1), (len(seqs) - 1, 2)):
        for t, k in zip(paths[m], _path_keys(seqs[m][0])):
            key[t] = k
            side[t] = side.get(t, 0) | bit
    n = len(tree.sym)
    convs, low, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    order = tree.upwards()
    for t in order:
        if t in ends:
            _, n_end, n_on, least = ends[t]
            convs[t] += n_end + n_on
            children[t] += n_on
            leaves[t] += n_on
            low[t] = least if low[t] is None else min(low[t], least)
        p = tree.parent[t]
        if p >= 0:
            convs[p] += convs[t]
            low[p] = low[t] if low[p] is None else min(low[p], low[t])
        if t not in side:
            leaves[t] = leaves[t] or 1
            saved[t] += (convs[t] - 1) * tree.words[t]
            children[p] += 1
            leaves[p] += leaves[t]
            saved[p] += saved[t]
    rows = []
    for t in order:
        p, end = tree.parent[t], ends.get(t)
        rows.append((1 if t in side else 0, shard, side.get(t, 0), key.get(t) or (end and end[0]), key.get(p), low[t], tree.depth[t],
                     None if p < 0 or p in side else low[p], convs[t], children[t], leaves[t], saved[t], end[1] if end else 0, tree.words[t]))
    yield from _batches(rows)


def _merge(last: bool):
    """Boundary nodes of neighbouring shards: kind 0 final, kind 1 still open."""
    def run(group, table):
        at = {c: i for i, c in enumerate(NAMES)}
        rows = list(zip(*(table.column(c).to_pylist() for c in NAMES)))
        shards = [r[at["shard"]] for r in rows]
        first, end, whole = min(shards), max(shards), group[0].as_py()
        nodes: dict[str, list] = {}
        for r in rows:
            s = r[at["shard"]]
            side = (r[at["side"]] & 1 if s == first else 0) | (r[at["side"]] & 2 if s == end else 0)
            x = nodes.setdefault(r[at["key"]], [0, None, 0, 0, 0, 0, 0, r[at["depth"]], r[at["words"]], r[at["parent_key"]]])
            low = r[at["conv_id"]]
            x[0] |= side
            x[1] = low if x[1] is None else min(x[1], low)
            for i, c in enumerate(("n_convs", "n_children", "n_leaves", "saved", "n_end"), 2):
                x[i] += r[at[c]]
        out = []
        for key, (side, low, n, children, leaves, saved, n_end, depth, words, up) in sorted(nodes.items(), key=lambda i: -i[1][7]):
            if side and not last:
                out.append((1, whole, side, key, up, low, depth, None, n, children, leaves, saved, n_end, words))
                continue
            leaves, saved = leaves or 1, saved + (n - 1) * words
            parent = nodes.get(up)
            if parent:
                parent[3] += 1
                parent[4] += leaves
                parent[5] += saved
            final = parent and (last or not parent[0])
            out.append((0, whole, 0, key, up, low, depth, parent[1] if final else None, n, children, leaves, saved, n_end, words))
        import pyarrow as pa
        return pa.Table.from_batches(_batches(out))
    return run


def _ends(ids: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): ids ascending, joined by commas."""
    def pieces(batches):
        import pyarrow as pa
        now, start, held, size = None, None, [], 0
        for b in batches:
            out = []
            for key, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if key != now or size >= PIECE:
                    if held:
                        out.append((now, start, ",".join(held)))
                    now, start, held, size = key, i, [], 0
                held.append(str(i))
                size += len(held[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], ["key", "start", "piece"]) if out else _no_piece()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (now, start, ",".join(held))], ["key", "start", "piece"])

    def _no_piece():
        import pyarrow as pa
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.int64(), pa.string())], ["key", "start", "piece"])

    def digest(batches):
        import pyarrow as pa
        now, h = None, None

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["key", "ends_sha256"])
        for b in batches:
            rows = []
            for key, piece in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if key != now:
                    if h:
                        rows.append((now, h.hexdigest()))
                    now, h = key, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(piece.encode())
            yield out(rows)
        if h:
            yield out([(now, h.hexdigest())])
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = (ids.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")
            .mapInArrow(K.lean(pieces), "key string, start long, piece string"))
    return held.repartition("key").sortWithinPartitions("key", "start").mapInArrow(K.lean(digest), "key string, ends_sha256 string")


def trie(conversations: tuple[DataFrame, DataFrame], shard: int = SHARD, fan: int = FAN) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 of every node, from (conv_id, length) and (conv_id, pos, what, words)."""
    convs, turns = conversations
    spots = scratch(turns.groupBy("pos", "what").agg(F.count(F.lit(1)).alias("n")), "spots")
    numbers = scratch(spots.select("what").distinct().withColumn("turn", F.monotonically_increasing_id()), "dictionary")
    spots = spots.join(numbers, "what").select("pos", "what", "turn", (F.col("n") == 1).alias("alone"))
    coded = scratch(turns.join(spots, ["pos", "what"]).select("conv_id", "pos", "turn", "words", "alone"), "coded")
    cuts = coded.where("alone").groupBy("conv_id").agg(F.min("pos").alias("cut"))
    convs = scratch(convs.join(cuts, "conv_id", "left").withColumn("cut", F.coalesce("cut", F.col("length") + 1)), "cuts")
    placed = coded.join(convs, "conv_id")
    shared = (placed.where("pos < cut").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "turn", "words"))).alias("s"))
              .select("conv_id", F.col("s.turn").alias("turns"), F.col("s.words").alias("words")))
    nothing = F.array().cast("array<long>")
    paths = convs.join(shared, "conv_id", "left").withColumns({"turns": F.coalesce("turns", nothing), "words": F.coalesce("words", nothing)})
    paths = scratch(paths.withColumn("key", F.md5(F.array_join(F.transform("turns", lambda t: t.cast("string")), ","))), "paths")
    whole = F.col("cut") > F.col("length")
    seqs = scratch(paths.groupBy("key").agg(
        F.first("turns").alias("turns"), F.first("words").alias("words"), F.sum(whole.cast("long")).alias("n_end"),
        F.sum((~whole).cast("long")).alias("n_on"), F.min("conv_id").alias("low")), "sequences")
    shards = int(seqs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0) // shard + 1

    grown = seqs.select("turns", "words", "key", "n_end", "n_on", "low").repartitionByRange(shards, "turns").sortWithinPartitions("turns")
    level = scratch(grown.mapInArrow(K.lean(_grow), NODES), "shards", wide=True)
    shards = (level.agg(F.max("shard")).first()[0] or 0) + 1
    final = level.where("kind = 0")
    while True:
        last = shards <= fan
        rim = level.where("kind = 1").withColumn("group", F.floor(F.col("shard") / fan).cast("long"))
        level = scratch(rim.groupBy("group").applyInArrow(_merge(last), NODES), "merged")
        final = final.union(level.where("kind = 0"))
        if last:
            break
        shards = -(-shards // fan)

    known = final.where("key is not null").select("key", F.col("conv_id").alias("known"))
    found = final.where("parent_conv_id is not null or parent_key is null")
    found = found.union(final.where("parent_conv_id is null and parent_key is not null")
                        .join(known.select(F.col("key").alias("parent_key"), "known"), "parent_key")
                        .withColumn("parent_conv_id", F.col("known")).select(*NAMES))
    ends = _ends(paths.where(whole).select("key", "conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"]
    found = found.where("n_end > 0").join(ends, "key").select(*columns).union(
        found.where("n_end = 0").withColumn("ends_sha256", F.lit(NONE)).select(*columns))

    def alone(rows: DataFrame, parent) -> DataFrame:
        on = F.col("depth") < F.col("length")
        return rows.select("conv_id", F.col("depth").cast("int").alias("depth"), parent.alias("parent_conv_id"), F.lit(1).cast("long"), on.cast("long"),
                           F.lit(1).cast("long"), F.lit(0).cast("long"), F.when(on, F.lit(NONE)).otherwise(F.sha2(F.col("conv_id").cast("string"), 256)))
    own = alone(paths.where(~whole).join(known, "key").withColumn("depth", F.col("cut")), F.col("known"))
    deep = alone(placed.where("pos > cut").withColumnRenamed("pos", "depth"), F.col("conv_id"))
    out = found.union(own).union(deep)
    return out.select(*[F.col(c).cast("long").alias(c) if c != "ends_sha256" else F.col(c) for c in out.columns])
