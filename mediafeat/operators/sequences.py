"""Sequence operators: steps per video (A5), ordered assembly (A6), fixed length
(F7 with the Q10 policy), flattening (F8) and pooling (M3).

Scale notes
-----------
* Where a length is given, only the first ``t`` steps of a video are ever gathered.  They are picked
  with ``row_number() <= t`` which Spark plans as ``WindowGroupLimit`` on both
  sides of the shuffle: each map task forwards at most ``t`` rows per video, so
  a video holding a third of all frames still reaches its reducer as
  ``t x map tasks`` rows and ``collect_list`` stays bounded by ``t``.  Whole sequences
  (``assemble_blocks``) come as numbered blocks of bounded length.
* The true length comes from a partial ``count`` aggregate on the same key; it
  is joined 1:1 on the already hash-partitioned id (no extra exchange).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def steps_per_video(frames: DataFrame, id_col: str = "id") -> DataFrame:
    """id, n_steps (A5, long form)."""
    return frames.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_steps"))


def first_steps(frames: DataFrame, id_col: str, order_cols: list[str], t: int, rn_col: str = "_rn") -> DataFrame:
    """Rows of the first ``t`` steps of each id, with their 1-based position."""
    w = Window.partitionBy(id_col).orderBy(*order_cols)
    return frames.withColumn(rn_col, F.row_number().over(w)).where(F.col(rn_col) <= t)


def assemble_sequences(frames: DataFrame, id_col: str, order_cols: list[str], vec: Column | str,
                       t: int, out_col: str = "seq", with_length: bool = True) -> DataFrame:
    """id, seq (first ``t`` step vectors in order), n_steps (true length) (A6+F7)."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    first = first_steps(frames.withColumn("_v", vec), id_col, order_cols, t)
    seq = (first.groupBy(id_col)
                .agg(F.array_sort(F.collect_list(F.struct("_rn", "_v"))).alias("_s"))
                .select(id_col, F.transform("_s", lambda s: s["_v"]).alias(out_col)))
    if not with_length:
        return seq
    return seq.join(steps_per_video(frames, id_col), id_col)


BLOCK_STEPS = 1024   # steps of a sequence that one row of an unlimited assembly holds


def assemble_blocks(frames: DataFrame, id_col: str, order_cols: list[str], vec: Column | str,
                    block_steps: int = BLOCK_STEPS, out_col: str = "seq") -> DataFrame:
    """id, block, seq, n_steps: all steps of every sequence, in order.

    A sequence is a run of blocks (0, 1, ...) of at most ``block_steps`` steps, so
    no row and no task holds a whole long one; step numbers come from the
    skew-safe ordering (:mod:`mediafeat.operators.ordering`)."""
    from mediafeat.operators.ordering import null_safe_join, number_rows
    vec = F.col(vec) if isinstance(vec, str) else vec
    t = number_rows(frames.select(id_col, *order_cols, vec.alias("_v")), [id_col], order_cols, "_rn")
    t = t.withColumn("block", F.floor((F.col("_rn") - 1) / block_steps).cast("int"))
    seq = (t.groupBy(id_col, "block").agg(F.array_sort(F.collect_list(F.struct("_rn", "_v"))).alias("_s"))
            .select(id_col, "block", F.transform("_s", lambda s: s["_v"]).alias(out_col)))
    return null_safe_join(seq, steps_per_video(frames, id_col), [id_col])


def fix_length(df: DataFrame, seq_col: str, t: int, short: str = "drop", zero: Column | None = None,
               len_col: str = "true_len") -> DataFrame:
    """Apply the short-sequence policy (Q10): 'drop', 'pad' (zero steps appended,
    true length emitted) or 'error'.  Longer sequences are cut to ``t``."""
    s = F.slice(F.col(seq_col), 1, t)
    out = df.withColumn(seq_col, s)
    n = F.size(F.col(seq_col))
    if short == "drop":
        return out.where(n == t)
    if short == "pad":
        z = zero if zero is not None else F.lit(0.0)
        pad = F.array_repeat(z, F.greatest(F.lit(0), F.lit(t) - n))
        return out.withColumn(len_col, n.cast("int")).withColumn(seq_col, F.concat(F.col(seq_col), pad))
    if short == "error":
        return out.withColumn(seq_col, F.when(n == t, F.col(seq_col)).otherwise(
            F.raise_error(F.concat(F.lit("sequence shorter than "), F.lit(str(t))))))
    raise ValueError("short must be 'drop', 'pad' or 'error'")


def pool_sequence(df: DataFrame, seq_col: str, d: int, prefix: str = "pool", decay: float = 0.5) -> DataFrame:
    """Per-dimension summaries of a sequence of d-vectors (M3): mean, max,
    first and last step, and decayed means -- ``fwd`` weights step t by
    ``decay ** (T-1-t)`` (recent steps count most, like a forward recurrent
    pass), ``bwd`` by ``decay ** t`` (early steps count most).

    Pure higher-order functions over the (bounded) sequence; returns one
    array<double>(d) column per statistic.
    """
    s = F.col(seq_col)
    n = F.size(s)
    dims = F.sequence(F.lit(0), F.lit(d - 1))

    def over(j, init, fn):
        return F.aggregate(s, init, lambda acc, v: fn(acc, v[j].cast("double")))

    def decayed(j, backward: bool):
        # step weights in sequence order, then a weighted mean
        w = F.transform(s, lambda v, t: F.pow(F.lit(decay), t if backward else n - 1 - t))
        num = F.aggregate(F.zip_with(s, w, lambda v, wt: v[j].cast("double") * wt), F.lit(0.0),
                          lambda a, x: a + x)
        den = F.aggregate(w, F.lit(0.0), lambda a, x: a + x)
        return num / den

    mean = F.transform(dims, lambda j: over(j, F.lit(0.0), lambda a, x: a + x) / n)
    mx = F.transform(dims, lambda j: over(j, F.lit(float("-inf")), lambda a, x: F.greatest(a, x)))
    first = F.transform(dims, lambda j: s[0][j].cast("double"))
    last = F.transform(dims, lambda j: F.element_at(s, -1)[j].cast("double"))
    fwd = F.transform(dims, lambda j: decayed(j, False))
    bwd = F.transform(dims, lambda j: decayed(j, True))
    return df.select("*", mean.alias(f"{prefix}_mean"), mx.alias(f"{prefix}_max"),
                     first.alias(f"{prefix}_first"), last.alias(f"{prefix}_last"),
                     fwd.alias(f"{prefix}_fwd"), bwd.alias(f"{prefix}_bwd"))


def step_count_mismatch(a: str, b: str) -> Column:
    """Quarantine predicate (Q13): the modalities of one video disagree on the
    number of steps (the source took the count from one and indexed the other)."""
    return F.coalesce(F.size(F.col(a)) != F.size(F.col(b)), F.lit(False))
