"""Ordering, limits, repeatable shuffles and hold-out splits.

Exact hold-out without a global window (T3)
-------------------------------------------
The source shuffles positions and keeps the last ``max(1, int(n * ratio))``
rows as validation.  Here each row gets a seeded key ``md5(id#seed)`` and the
``dev_n`` largest keys form the validation split.  Finding the ``dev_n``-th
largest key is done without sorting the data into one task: a histogram over
the first hex digits of the key (at most 65,536 counts, partial aggregation)
says which bucket holds the cut and how deep; the search repeats inside that
bucket until it holds at most ``direct_limit`` keys, which a bounded top-k
finishes.  The split itself is then one narrow projection ``key >= cut``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 4            # hex digits per histogram level -> at most 65,536 buckets
DIRECT_LIMIT = 200_000  # top-k size finished in one bounded TakeOrderedAndProject


def shuffle_key(id_col: str | Column, seed: int | str) -> Column:
    """Seeded, engine-independent permutation key."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit("#"), F.lit(str(seed))))


def seeded_shuffle(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Rows in a repeatable random order (a sort on the seeded key; ties by id)."""
    return df.withColumn("shuffle_key", shuffle_key(id_col, seed)).orderBy("shuffle_key", id_col)


def _histogram(cand: DataFrame, level: int) -> list[tuple[str, int]]:
    rows = (cand.groupBy(F.substring("_k", level + 1, DIGITS).alias("_b"))
                .agg(F.count(F.lit(1)).alias("_n")).collect())
    return sorted(((r["_b"], r["_n"]) for r in rows), reverse=True)


def kth_largest_key(df: DataFrame, key_col: str, k: int | None, direct_limit: int = DIRECT_LIMIT,
                    k_of_n=None) -> str | None:
    """The k-th largest value of a lower-case hex key column (exact, distributed).

    Only bucket counts (<= 16**DIGITS rows) and one key ever reach the driver.
    ``k_of_n`` derives k from the row count, which the first histogram gives
    for free (no separate count pass).
    """
    cand = df.where(F.col(key_col).isNotNull()).select(F.col(key_col).alias("_k"))
    hist = _histogram(cand, 0)
    if k_of_n is not None:
        k = k_of_n(sum(n for _, n in hist))
    if not k or k <= 0:
        return None
    prefix, remaining, width = "", k, None
    for level in range(0, 32, DIGITS):
        if width is not None and width <= direct_limit:
            break
        if level > 0:
            hist = _histogram(cand, level)
        above = 0
        for b, n in hist:
            if above + n >= remaining:
                prefix += b
                remaining -= above
                width = n
                break
            above += n
        else:
            return None  # fewer than k keys
        cand = cand.where(F.col("_k").startswith(prefix))
    if len(prefix) == 32:
        return prefix        # many rows of one id: the key itself is known
    top = cand.orderBy(F.col("_k").desc()).limit(remaining).agg(F.min("_k").alias("cut")).first()
    return top["cut"]


def split_holdout(df: DataFrame, id_col: str, ratio: float, seed: int, exact: bool = True,
                  split_col: str = "split") -> DataFrame:
    """Add ``split`` = 'train' | 'dev'.

    ``exact=True``: dev holds exactly ``max(1, floor(n * ratio))`` rows, the
    largest seeded keys (the source's size rule, Q6; reproducible, Q7), when
    ids are unique; rows sharing an id share a key and land on the same side.
    Rows with a null id are always 'train' and do not count towards ``n``.
    ``exact=False``: one pass, a hash bucket decides (size only in expectation).
    """
    keyed = df.withColumn("_key", shuffle_key(id_col, seed))
    if not exact:
        bucket = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(str(seed))), F.lit(1_000_000))
        return keyed.withColumn(split_col, F.when(bucket < int(ratio * 1_000_000), "dev").otherwise("train")).drop("_key")
    # the cut search scans the key column several times: a narrow key table,
    # written once when the input is large (not the whole input plan each pass)
    from mediafeat.operators.parallel import reuse
    keys = reuse(keyed.select("_key"), source=df)
    cut = kth_largest_key(keys, "_key", None,
                          k_of_n=lambda n: max(1, int(math.floor(n * ratio))) if n else 0)
    if cut is None:
        return keyed.withColumn(split_col, F.lit("train")).drop("_key")
    return keyed.withColumn(split_col, F.when(F.col("_key") >= F.lit(cut), "dev").otherwise("train")).drop("_key")


def take_ordered(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """First n rows by a key (T1); planned as a bounded TakeOrderedAndProject."""
    return df.orderBy(*key).limit(n)


GROUP_LIMIT = 1000   # up to here the optimizer trims groups before the shuffle by itself


def limit_per_group(df: DataFrame, group: str, order: list[str], n: int, rn_col: str = "rn") -> DataFrame:
    """At most n rows per group (S14, W5); ``row_number() <= n`` is planned as
    WindowGroupLimit, which also trims each group before the shuffle.  Beyond the
    optimizer's threshold rows are numbered in blocks of bounded size instead, so a
    hot group is never one task's work (null order keys first, as in the window)."""
    if n > GROUP_LIMIT:
        from mediafeat.operators.ordering import number_rows
        return number_rows(df, [group], order, rn_col).where(F.col(rn_col) <= n)
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rn_col, F.row_number().over(w)).where(F.col(rn_col) <= n)


def exclude_values(df: DataFrame, col: str, names: list[str] | DataFrame) -> DataFrame:
    """Drop rows whose ``col`` is one of ``names`` (S12); a null ``col`` is no name and
    stays.  A list becomes a literal filter, pushed to the scan when ``col`` is a
    partition or data column; a one-column frame (a list of any length) an anti-join."""
    if isinstance(names, DataFrame):
        gone = names.select(F.col(names.columns[0]).alias("_gone")).distinct()
        return df.join(gone, F.col(col) == F.col("_gone"), "left_anti")
    return df.where(F.col(col).isNull() | ~F.col(col).isin(list(names)))


INLINE_VALUES = 10_000  # value lists up to this size become a literal IN filter


def limit_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """Keep rows of the first n distinct values of ``col`` by name (S13); a null is no
    name: it uses up no place and its rows go.

    The first n names (a bounded list, read from the column alone) become a
    literal IN filter, so on a ``partitionBy(col)`` layout the other shards are
    pruned at file listing and never read.  Beyond ``INLINE_VALUES`` names the
    list stays distributed, in a semi-join that Spark plans by its size."""
    first = df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).limit(n)
    if n <= INLINE_VALUES:
        names = [r[0] for r in first.collect()]
        return df.where(F.col(col).isin(names))
    return df.join(first, col, "left_semi")


def chunk_assignment(items: DataFrame, item_col: str, k: int) -> DataFrame:
    """item, chunk: ceil(n/k)-sized runs in name order.

    Runs over a list of shards/files -- small by nature -- so one window
    partition is fine here."""
    w_all = Window.partitionBy()
    w = Window.orderBy(item_col)
    d = items.select(item_col).distinct()
    step = F.ceil(F.count(F.lit(1)).over(w_all) / F.lit(float(k)))
    return d.select(item_col, F.floor((F.row_number().over(w) - 1) / step).cast("int").alias("chunk"))


def split_check(full: DataFrame, train: DataFrame, dev: DataFrame) -> DataFrame:
    """n_full, n_train, n_dev, n_both (distinct rows on both sides), n_lost (rows of
    full on neither side) and n_extra (the opposite) (U2): one tagged union, one
    aggregate per distinct row, one total."""
    cols = full.columns
    tags = ["_full", "_train", "_dev"]
    tagged = None
    for frame, own in zip((full, train, dev), tags):
        part = frame.select(*cols, *[F.lit(int(own == t)).alias(t) for t in tags])
        tagged = part if tagged is None else tagged.unionByName(part)
    rows = tagged.groupBy(*cols).agg(*[F.sum(t).alias(t) for t in tags])
    f, t, d = (F.col(c) for c in tags)
    zero = F.lit(0).cast("bigint")
    sums = rows.agg(*[F.coalesce(F.sum(c), zero).alias(n) for n, c in (
        ("n_full", f), ("n_train", t), ("n_dev", d), ("n_both", ((t > 0) & (d > 0)).cast("bigint")),
        ("n_lost", F.greatest(f - t - d, zero)), ("n_extra", F.greatest(t + d - f, zero)))])
    return sums.unpivot([], ["n_full", "n_train", "n_dev", "n_both", "n_lost", "n_extra"], "m", "v")


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Append results by column name, keeping duplicates."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def exclude_shards(df: DataFrame, names: list[str], shard_col: str = "shard") -> DataFrame:
    return exclude_values(df, shard_col, names)


def limit_shards(df: DataFrame, n: int, shard_col: str = "shard") -> DataFrame:
    return limit_values(df, shard_col, n)


def limit_per_shard(df: DataFrame, n: int, order: list[str], shard_col: str = "shard") -> DataFrame:
    return limit_per_group(df, shard_col, order, n)
