"""Exact per-group order statistics that stay balanced when one group is huge.

``row_number()`` or a running ``min`` over ``PARTITION BY g ORDER BY o`` puts
every row of a group in one task; a video or run holding a third of all rows
would make that task a third of the job.  Instead:

1. rows per group -- a partial aggregate; groups above ``hot_rows`` are hot (with
   no hot group the plain window is used);
2. for each hot group, ``blocks - 1`` cut points of the leading order key: the
   evenly spaced values of a sorted sample, chosen by a hash of the order keys
   (any orderable type; at most a few thousand values per group);
3. every row gets a block number from the cut points below its key, rows that equal a
   cut point a block of their own: value-based, so any recomputation (retries, executor
   loss) gives the same blocks; rows with an equal leading key always share a block, so
   the order is preserved.  A block still above ``hot_rows`` is cut again, on the first
   order key that is not the same in all its rows, level by level, until none is (or
   its rows share all keys);
4. the statistic inside (group, block) by a window -- the shuffle is on
   (group, block), spreading a hot group over ``blocks`` tasks;
5. combined with the same statistic over the earlier blocks of the group (a
   window over at most ``blocks`` summary rows per group, joined back on
   (group, block); the big side keeps its partitioning, only the small side moves).

Null groups are groups of their own on both paths: all joins are null-safe.  Null
order keys come first, as Spark orders them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = None        # a group above this many rows is split; None: from executor memory
ROW_BYTES = 512        # working-set bytes assumed per row when deriving HOT_ROWS
BLOCKS = 64            # cut points of a hot group at each level
LEVELS = 8             # of cuts
MAX_HOT = 10_000       # groups whose cut points are broadcast; more are joined by a shuffle (AQE splits skew)
SAMPLE = 4096          # expected values sampled per hot group for its cut points
BLK = "_blk"


def hot_rows_for(spark) -> int:
    """Rows one window task may take: a quarter of a task slot's memory."""
    if HOT_ROWS is not None:
        return HOT_ROWS
    from mediafeat.session import memory_per_core
    return max(100_000, memory_per_core(spark) // 4 // ROW_BYTES)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null; the keys come from the left side."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])   # hints stay
    on = None
    for k in keys:
        eq = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = eq if on is None else on & eq
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _small(df: DataFrame, n: int) -> DataFrame:
    """``df`` has a row for each of ``n`` counted groups: broadcast if they are few."""
    return F.broadcast(df) if n <= MAX_HOT else df


def _cuts(rows: DataFrame, hot: DataFrame, keys: list[str], key: str, order: list[str], blocks: int, out: str) -> DataFrame:
    """Cut points of ``key`` for each of the ``hot`` groups (with their size ``_n``)."""
    slot = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(1 << 30))
    picked = null_safe_join(rows, hot, keys).where(slot < F.lit(float(SAMPLE << 30)) / F.col("_n"))
    values = picked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.col(key))).alias("_v"))   # nulls need no cut
    at = F.sequence(F.lit(1), F.lit(blocks - 1))
    return values.where(F.size("_v") > 0).select(*keys, F.array_distinct(F.transform(
        at, lambda i: F.element_at("_v", (F.floor(i * F.size("_v") / blocks) + 1).cast("int")))).alias(out))


def with_blocks(df: DataFrame, group: list[str], order: list[str], hot_rows: int | None = None,
                blocks: int = BLOCKS) -> tuple[DataFrame, bool]:
    """Append ``_blk`` (0 for ordinary groups); returns (frame, any_hot)."""
    hot_rows = hot_rows or hot_rows_for(df.sparkSession)
    hot = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    n_hot = hot.count()
    if not n_hot:
        return df.withColumn(BLK, F.lit(0)), False

    def block(cuts: str, key: str) -> Column:
        below = F.size(F.filter(cuts, lambda c: c < F.col(key))).cast("long")
        return F.when(F.col(cuts).isNull() | F.col(key).isNull(), F.lit(0).cast("long")).otherwise(      # nulls have a block
            1 + 2 * below + F.array_contains(cuts, F.col(key)).cast("long"))
    cuts = _cuts(df, _small(hot, n_hot), group, order[0], order, blocks, "_cuts")
    out = null_safe_join(df, _small(cuts, n_hot), group, "left").withColumn(BLK, block("_cuts", order[0])).drop("_cuts")
    from mediafeat.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    keys = [*group, BLK]

    def too_large(rows: DataFrame) -> DataFrame:
        """The blocks to cut again: their size ``_n`` and ``_key``, the first order key in
        which their rows differ."""
        ends = [f(k).alias(f"_{n}{i}") for i, k in enumerate(order) for n, f in (("lo", F.min), ("hi", F.max), ("set", F.count))]
        over = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *ends).where(F.col("_n") > hot_rows)
        differs = [(F.col(f"_set{i}") > 0) & ((F.col(f"_set{i}") < F.col("_n")) | (F.col(f"_lo{i}") < F.col(f"_hi{i}"))) for i in range(len(order))]
        return over.select(*keys, "_n", F.coalesce(*[F.when(d, F.lit(i)) for i, d in enumerate(differs)]).alias("_key")).where("_key is not null")

    for _ in range(LEVELS - 1):
        found = {r["_key"]: r["n"] for r in too_large(out).groupBy("_key").agg(F.count(F.lit(1)).alias("n")).collect()}    # a row for each order key
        if not found:
            break
        out = out.checkpoint()          # read three times for this level
        over, cut, sub = too_large(out), out, F.lit(0).cast("long")
        for i, n in sorted(found.items()):
            some = over.where(F.col("_key") == i).select(*keys, "_n")
            cut = null_safe_join(cut, _small(_cuts(out, _small(some, n), keys, order[i], order, blocks, f"_cuts{i}"), n), keys, "left")
            sub = sub + block(f"_cuts{i}", order[i])
        out = cut.withColumn(BLK, F.col(BLK) * F.lit(2 * blocks + 2) + sub).drop(*[f"_cuts{i}" for i in found])
    return out, True


_AGG = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}


def _combine(fn: str, within: Column, prev: Column) -> Column:
    if fn == "min":
        return F.least(within, prev)        # least/greatest skip nulls
    if fn == "max":
        return F.greatest(within, prev)
    both_null = within.isNull() & prev.isNull()
    return F.when(both_null, F.lit(None)).otherwise(F.coalesce(within, F.lit(0)) + F.coalesce(prev, F.lit(0)))


def running(df: DataFrame, group: list[str], order: list[str], value: str | Column, fn: str, out: str,
            exclusive: bool = False, blocked: bool = True) -> DataFrame:
    """Running ``fn`` (min, max, sum, count) of ``value`` over the rows before
    (``exclusive``) or up to each row of its group.  ``df`` must carry ``_blk``
    from :func:`with_blocks`; ``blocked=False`` (no hot group) uses the plain window."""
    v = F.col(value) if isinstance(value, str) else value
    agg = _AGG[fn]
    end = -1 if exclusive else 0
    if not blocked:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        return df.withColumn(out, agg(v).over(w))
    w_in = Window.partitionBy(*group, BLK).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    t = df.withColumn("_within", agg(v).over(w_in))
    summary = df.groupBy(*group, BLK).agg(agg(v).alias("_b"))
    before = Window.partitionBy(*group).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    outer = _AGG["sum"] if fn == "count" else agg
    summary = summary.select(*group, BLK, outer("_b").over(before).alias("_prev"))
    j = null_safe_join(t, summary, [*group, BLK])
    return j.withColumn(out, _combine(fn, F.col("_within"), F.col("_prev"))).drop("_within", "_prev")


def number_blocks(t: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """Exact row numbers of rows that carry ``_blk`` (kept, so that later steps
    need no second count of the groups)."""
    local = t.withColumn("_lrn", F.row_number().over(Window.partitionBy(*group, BLK).orderBy(*order)))
    sizes = t.groupBy(*group, BLK).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*group).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, BLK, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    j = null_safe_join(local, offsets, [*group, BLK])
    return j.withColumn(out, (F.col("_lrn") + F.col("_off")).cast("int")).drop("_lrn", "_off")


def number_rows(df: DataFrame, group: list[str], order: list[str], out: str = "rn",
                hot_rows: int | None = None, blocks: int = BLOCKS) -> DataFrame:
    """Append an exact 1-based row number per group following ``order`` (ties
    must not exist)."""
    t, hot = with_blocks(df, group, order, hot_rows, blocks)
    if not hot:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return number_blocks(t, group, order, out).drop(BLK)
