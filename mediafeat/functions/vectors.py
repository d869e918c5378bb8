"""Vector expressions: arg-max, dims, fusion, flattening, dot products, uint8 decode."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax(v) -> Column:
    """0-based index of the first maximum (F5); null for an empty vector."""
    v = _col(v)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def dims(v) -> Column:
    """Vector length."""
    return F.size(_col(v)).cast("int")


def fuse(*vs) -> Column:
    """Early fusion: concatenate feature vectors."""
    return F.concat(*[_col(v) for v in vs])


def flatten(seq) -> Column:
    """Stack a sequence of vectors into one flat vector (F8)."""
    return F.flatten(_col(seq))


def preview(v, n: int) -> Column:
    """First n entries of a vector (P5)."""
    return F.slice(_col(v), 1, n)


def widen(v, nested: bool = False) -> Column:
    """float -> double for vectors or sequences of vectors."""
    return _col(v).cast("array<array<double>>" if nested else "array<double>")


def dot(a, b) -> Column:
    """Sequential dot product of two equally long vectors."""
    prods = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def matvec(weights: list[list[float]], x) -> Column:
    """Scores of a linear model with constant (broadcast in the plan) weights."""
    rows = F.array(*[F.array(*[F.lit(float(w)) for w in row]) for row in weights])
    x = _col(x)
    return F.transform(rows, lambda w: dot(w, x))


SLICE = 4 << 20        # bytes decoded at a time: their floats take four times as much


def _slices(size: np.ndarray):
    """Ranges of values of ``SLICE`` bytes together, or of one that is larger."""
    end, i = np.cumsum(size), 0
    while i < len(size):
        k = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + SLICE, "right")))
        yield i, k
        i = k


def _floats(b: pa.Array) -> pa.Array:
    """A list of the bytes of each value as floats."""
    at = np.frombuffer(b.buffers()[1], np.int32)[b.offset:b.offset + len(b) + 1] if len(b) else np.zeros(1, np.int32)     # none: no offsets either
    raw = np.frombuffer(b.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    return pa.ListArray.from_arrays(pa.array(at - at[0]), pa.array(raw.astype(np.float32)), mask=b.is_null())


def _sizes(b: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(b), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _returned(run):
    """``run``, after which its worker gives freed memory back: it lives on beside others."""
    @functools.wraps(run)
    def out(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return out


@F.arrow_udf(T.ArrayType(T.FloatType()))
@_returned
def decode_u8(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Byte string -> float vector of its unsigned 8-bit values, no rescaling.

    Arrow-batched: one numpy view per slice of a batch, no per-byte Python; a worker
    holds a batch of bytes and the floats of ``SLICE`` of them.
    """
    for b in batches:
        b = b.cast(pa.binary())
        for i, k in _slices(_sizes(b)):
            yield _floats(b[i:k])


@F.arrow_udf(T.ArrayType(T.ArrayType(T.FloatType())))
@_returned
def decode_u8_steps(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """array<binary> (one uint8 vector per step, as in frame-level records) ->
    array<array<float>> (F3 applied to every step), Arrow-batched."""
    for b in batches:
        b = b.cast(pa.list_(pa.binary()))
        size = np.zeros(len(b), np.int64)
        np.add.at(size, pc.list_parent_indices(b).to_numpy(zero_copy_only=False), _sizes(b.flatten()))
        for i, k in _slices(size):
            part = b[i:k]
            n = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(at), _floats(part.flatten()), mask=part.is_null())


def decode_u8_sql(b) -> Column:
    """Same as :func:`decode_u8` with built-ins only (hex pairs -> ints).

    Exact and JVM-side; slower than the Arrow kernel for 1024-wide frames.
    """
    h = F.hex(_col(b))
    n = (F.length(h) / 2).cast("int")
    return F.when(n == 0, F.array().cast("array<float>")).otherwise(
        F.transform(F.sequence(F.lit(0), n - 1),
                    lambda i: F.conv(F.substring(h, i * 2 + 1, 2), 16, 10).cast("float")))
