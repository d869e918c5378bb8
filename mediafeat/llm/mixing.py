"""Mixing sources to target weights by a hypergeometric splitting tree.

A source's documents fall into up to ``blocks`` disjoint blocks by a seeded hash.
Its target (words) becomes an exact quota of blocks: whole epochs, then blocks in
a second seeded order until the target is reached.  (Blocks of a source with fewer
documents than blocks are mostly single documents.)  A binary tree over the output shards splits each node's quotas by a
multivariate hypergeometric draw, so every shard gets an exact number of blocks
and, per source, as many as a uniformly random deal would give it.  The shard's
blocks are then a contiguous run of the source's permuted draw, and rows are
ordered inside the shard by a seeded hash.

All row work is column expressions; the driver holds one row per source and one
integer per source and shard.

Nulls: a null source is a source of its own (the last); a null or empty text has
size 0 and is taken 0 times its size.  Equal rows hash alike and share a block.
An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediafeat.llm.common import WORD, scratch

WEIGHTS = (5, 2, 1)   # by source in code point order, repeating
CEILING = 3           # a source gives at most so many times its size
BLOCKS = 8192         # blocks of a source


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, ceiling: int = CEILING) -> dict[str | None, float]:
    """Words to take of every source: ``weights`` share the sum of the sizes; what
    a source cannot give (``ceiling`` times its size) is shared again."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    left, out, open_ = float(sum(size.values())), {}, dict(weight)
    while open_:
        share = left / sum(open_.values())
        full = [s for s in open_ if ceiling * size[s] < share * open_[s]]
        if not full:
            return out | {s: share * w for s, w in open_.items()}
        for s in full:
            out[s] = float(ceiling * size[s])
            left -= out[s]
            del open_[s]
    return out


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """(shards, sources) block counts: rows sum to nearly equal shard sizes,
    columns to ``quotas``; each tree node draws its left half's share."""
    out = np.zeros((shards, len(quotas)), np.int64)
    rng = np.random.default_rng(seed)

    def split(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid, total = (lo + hi) // 2, int(have.sum())
        take = total * (mid - lo) // (hi - lo)
        left, pool, need = np.zeros_like(have), total, take
        for i, n in enumerate(have):      # a multivariate draw, one source at a time
            pool -= int(n)
            got = int(rng.hypergeometric(int(n), pool, need)) if need and n else 0
            left[i], need = got, need - got
        split(lo, mid, left)
        split(mid, hi, have - left)

    split(0, shards, np.array(quotas, np.int64))
    return out


def _key(c: str) -> Column:
    """A source as a join key: null stays apart from the empty text."""
    return F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(c)))


def _block(blocks: int, seed: int) -> Column:
    """The block of a row within its source: a seeded hash of id and text."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))), F.lit(blocks)).cast("int")


def plan(rows: DataFrame, shards: int = 16, seed: int = 17, weights=WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """``rows``: skey, source, block, size.  One row per (source, block): skey, block,
    source_size, target, shards (one output shard for each time the block is drawn).

    A source draws all its blocks in whole epochs, then blocks in a seeded order
    until the rest of its target is reached (a block whose middle lies within it).
    The tree splits the numbers of drawn blocks among the shards; a source's draws,
    in another seeded order, go to the shards by those numbers."""
    spark = rows.sparkSession
    by_block = scratch(rows.groupBy("skey", "source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    per = by_block.groupBy("skey", "source").agg(F.sum("words").alias("words")).collect()      # one row per source
    goal = targets([(r.source, r.words) for r in per], weights, ceiling)
    sources = []
    for r in per:
        full = int(goal[r.source] // r.words) if r.words else 0
        sources.append((r.skey, r.words, float(goal[r.source]), full, goal[r.source] - full * r.words))
    src = spark.createDataFrame(sources, "skey string, source_size long, target double, epochs int, rest double").coalesce(1)
    order = Window.partitionBy("skey").orderBy(F.xxhash64(F.lit(seed + 1), F.col("block")), "block") \
        .rowsBetween(Window.unboundedPreceding, -1)                                             # BLOCKS rows a source at most
    before = F.coalesce(F.sum("words").over(order), F.lit(0))
    drawn = scratch(by_block.join(src, "skey").withColumn("more", (before + F.col("words") / 2 <= F.col("rest")).cast("int"))
                    .select("skey", "block", "source_size", "target", (F.col("epochs") + F.col("more")).alias("times")), "mix-drawn")
    quota = {r.skey: r.q for r in drawn.groupBy("skey").agg(F.sum("times").alias("q")).collect()}
    keys = sorted(quota)
    ends = np.cumsum(split_quotas([quota[k] for k in keys], shards, seed), axis=0)
    ends = spark.createDataFrame([(k, [int(x) for x in ends[:, i]]) for i, k in enumerate(keys)], "skey string, ends array<long>").coalesce(1)
    draws = drawn.where("times > 0").select("skey", "block", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("epoch"))
    rank = Window.partitionBy("skey").orderBy(F.xxhash64(F.lit(seed + 3), F.col("block"), F.col("epoch")), "block", "epoch")
    placed = (draws.withColumn("r", F.row_number().over(rank)).join(ends, "skey")
              .select("skey", "block", F.size(F.filter("ends", lambda e: e < F.col("r"))).alias("shard"))
              .groupBy("skey", "block").agg(F.sort_array(F.collect_list("shard")).alias("shards")))   # CEILING entries at most
    return scratch(drawn.join(placed, ["skey", "block"], "left").select(
        "skey", "block", "source_size", "target", F.coalesce("shards", F.array().cast("array<int>")).alias("shards")), "mix-plan")


def mix_report(docs: DataFrame, blocks: int = BLOCKS, seed: int = 17, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, shards of every document."""
    rows = scratch(docs.select("doc_id", F.col("source").cast("string").alias("source"), _key("source").alias("skey"),
                               n_words(F.col("text")).alias("size"), _block(blocks, seed).alias("block")), "mix-rows")
    return rows.join(plan(rows, seed=seed, **options), ["skey", "block"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), F.size("shards").alias("copies"),
        F.array_join("shards", ",").alias("shards"))


def mix(docs: DataFrame, shard_column: str | None = None, blocks: int = BLOCKS, seed: int = 17, **options) -> DataFrame:
    """The mixed rows: every column of ``docs``, a row as often as the mix takes it;
    with ``shard_column`` also its output shard.  A row without words is neutral: it
    fares like its block."""
    key, block = _key("source"), _block(blocks, seed)
    rows = docs.select(F.col("source").cast("string").alias("source"), key.alias("skey"), n_words(F.col("text")).alias("size"), block.alias("block"))
    draws = plan(rows, seed=seed, **options).select(F.col("skey").alias("_mix_s"), F.col("block").alias("_mix_b"), F.explode("shards").alias("_mix_shard"))
    extra = [F.col("_mix_shard").alias(shard_column)] if shard_column else []
    return (docs.withColumns({"_mix_s": key, "_mix_b": block}).join(draws, ["_mix_s", "_mix_b"])
            .select(*[F.col(f"`{c}`") for c in docs.columns], *extra))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 17, **options) -> None:
    """The mix as Parquet, one folder per output shard, rows shuffled inside it by
    a seeded hash."""
    mixed = mix(docs, "mix_shard", seed=seed, shards=shards, **options)
    order = F.xxhash64(F.lit(seed + 4), F.col("doc_id"), F.col("mix_shard"))
    (mixed.withColumn("_mix_o", order).repartition(shards * 4, "mix_shard", F.pmod("_mix_o", F.lit(4)))
     .sortWithinPartitions("mix_shard", "_mix_o").drop("_mix_o").write.partitionBy("mix_shard").parquet(path))
