"""Label encoders as Catalyst expressions (no Python per row).

F1 ``multihot_positional``: ids 0..K-1 map to their own slot, nothing else.
F2 ``multihot_vocab``: slots follow a fitted vocabulary (at most K-1 labels);
   unused slots stay 0; the last slot is "other" and is 1 only when none of
   the row's labels is in the vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def multihot_positional(labels, k: int) -> Column:
    """array<double>(k): slot i is 1 when label i is present (F1, F16)."""
    labels = _col(labels)
    slots = F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint"))
    return F.transform(
        slots, lambda i: F.when(F.array_contains(labels, i), F.lit(1.0)).otherwise(F.lit(0.0)))


def vocab_array(values: Sequence[int]) -> Column:
    """Literal array<bigint> for a fitted (bounded) vocabulary."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.array(*[F.lit(int(v)).cast("bigint") for v in values])


def multihot_vocab(labels, vocab: Sequence[int], k: int, with_other: bool = True) -> Column:
    """array<double>(k) for a vocabulary of at most k-1 labels."""
    width = k - 1 if with_other else k
    if len(vocab) > width:
        raise ValueError(f"vocabulary of {len(vocab)} labels does not fit {width} slots")
    labels = _col(labels)
    v = vocab_array(vocab)
    hits = F.transform(v, lambda l: F.when(F.array_contains(labels, l), F.lit(1.0)).otherwise(F.lit(0.0)))
    parts = [hits]
    if width - len(vocab) > 0:
        parts.append(F.array_repeat(F.lit(0.0), width - len(vocab)))
    if with_other:
        any_kept = F.coalesce(F.arrays_overlap(labels, v), F.lit(False))
        parts.append(F.array(F.when(any_kept, F.lit(0.0)).otherwise(F.lit(1.0))))
    return F.concat(*parts) if len(parts) > 1 else parts[0]
