"""Evaluation and run metrics.

All of them are aggregates or joins on executors: only a handful of numbers
reach the driver.  Per-run ordered metrics avoid whole-run windows where an
aggregate says the same thing: the first value of a run is ``min_by`` (a
partial aggregate, safe for a run holding a third of the rows), joined back on
the run key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediafeat.functions.vectors import argmax


def topclass_accuracy(df: DataFrame, y_col: str, score_col: str, by: list[str] | None = None) -> DataFrame:
    """n, correct, accuracy: arg-max of target equals arg-max of scores.

    First maximum wins; an all-zero target counts as class 0.
    """
    hit = (argmax(y_col) == argmax(score_col)).cast("int")
    g = df.groupBy(*(by or []))
    return g.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).cast("bigint").alias("correct"),
                 F.round(F.avg(hit.cast("double")), 6).alias("accuracy"))


def class_accuracy(df: DataFrame, cls_col: str, score_col: str) -> DataFrame:
    """Same, with the target given as a class index."""
    hit = (F.col(cls_col) == argmax(score_col)).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).cast("bigint").alias("correct"),
                  F.round(F.avg(hit.cast("double")), 6).alias("accuracy"))


def softmax_xent(scores: Column, cls: Column) -> Column:
    """-log softmax(scores)[cls], numerically stable (M6)."""
    m = F.array_max(scores)
    lse = m + F.log(F.aggregate(scores, F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - m)))
    return lse - F.element_at(scores, cls + 1).cast("double")


def categorical_crossentropy(df: DataFrame, cls_col: str, score_col: str, by: list[str] | None = None) -> DataFrame:
    """Mean cross-entropy of soft-max scores against a class index (M6)."""
    loss = softmax_xent(F.col(score_col), F.col(cls_col))
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(loss), 6).alias("loss"))


def speedup(runs: DataFrame, group: str, order: list[str], value: str, out: str = "speedup") -> DataFrame:
    """value of the group's first row (by ``order``) divided by each row's value.

    First row via ``min_by`` (partial aggregate) + equi-join, not a whole-group window.
    """
    first = runs.groupBy(group).agg(
        F.min_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias("_first"))
    from mediafeat.operators.ordering import null_safe_join
    j = null_safe_join(runs, first, [group])
    return j.withColumn(out, F.try_divide(F.col("_first"), F.nullif(F.col(value), F.lit(0.0)))).drop("_first")


def efficiency(df: DataFrame, speedup_col: str, nodes_col: str, out: str = "efficiency") -> DataFrame:
    """Speed-up relative to the ideal (linear) line."""
    return df.withColumn(out, F.try_divide(F.col(speedup_col), F.col(nodes_col).cast("double")))


def early_stopping(hist: DataFrame, run: str, epoch: str, loss: str, patience: int = 3,
                   hot_rows: int | None = None, blocks: int | None = None) -> DataFrame:
    """Per run: stop_epoch, best_epoch, best_loss, n_saved.

    Early-stopping semantics with a zero minimum delta: an epoch improves when its loss is below
    every earlier loss; training stops at the first epoch that is ``patience``
    epochs past the last improvement (else it runs to the last epoch); the
    checkpoint kept is the best epoch up to the stop.

    Both running statistics (best loss before each epoch, last improving
    epoch) are skew-safe prefix scans (:mod:`mediafeat.operators.ordering`):
    a run holding a third of all rows is split into blocks, not one task.
    """
    from mediafeat.operators import ordering as O
    h, hot = O.with_blocks(hist, [run], [epoch], hot_rows, blocks or O.BLOCKS)
    h = O.running(h, [run], [epoch], loss, "min", "_best_before", exclusive=True, blocked=hot)
    h = h.withColumn("_improved", F.col("_best_before").isNull() | (F.col(loss) < F.col("_best_before")))
    h = O.running(h, [run], [epoch], F.when(F.col("_improved"), F.col(epoch)), "max", "_last_imp",
                  exclusive=False, blocked=hot)
    h = h.withColumn("_trigger", (F.col(epoch) - F.col("_last_imp")) >= patience)
    # the windowed history feeds both the stop aggregate and the join back:
    # written once when the input is large, instead of windowing twice
    from mediafeat.operators.parallel import reuse
    h = reuse(h, source=hist)
    stop = h.groupBy(run).agg(
        F.coalesce(F.min(F.when(F.col("_trigger"), F.col(epoch))), F.max(epoch)).alias("stop_epoch"))
    hs = O.null_safe_join(h, stop, [run]).where(F.col(epoch) <= F.col("stop_epoch"))
    return hs.groupBy(run).agg(
        F.max("stop_epoch").alias("stop_epoch"),
        F.min_by(F.col(epoch), F.struct(F.col(loss), F.col(epoch))).alias("best_epoch"),
        F.min(loss).alias("best_loss"),
        F.count_if(F.col("_improved")).alias("n_saved"))
