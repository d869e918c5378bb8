"""Numpy kernels over Arrow text columns, used inside Spark tasks.

Texts are handled as one byte buffer with document bounds; word and window hashes
come from prefix sums of ``random(byte) * P**position`` modulo 2**64, so that the
hash of any byte range is a difference of two sums: no Python per word or byte.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator

import numpy as np

U = np.uint64
P = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def lean(run):
    """``run`` over batches, after which its worker gives freed memory back to the
    system: a worker lives on, beside those of the next stages."""
    @functools.wraps(run)
    def out(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()
    return out


def _give_back() -> None:
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc alone has it
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _randoms(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(P) + U(seed))


BYTE = _randoms(1)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def chain(base: int) -> np.ndarray:
        out = np.full(n, base, U)
        out[0] = 1
        return np.multiply.accumulate(out)
    return chain(P), chain(pow(P, -1, 1 << 64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i for i < n at least."""
    return _powers(max(1 << 20, 1 << (n - 1).bit_length()))


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of an Arrow string column; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def runs(bounds: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes (one document at least)."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        yield i, j
        i = j


def range_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums S of value * P**i: the hash of [s, e) is (S[e]-S[s]) * P**-s."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    h = (sums[end] - sums[start]) * down[start]
    return mix(h + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~SPACE[data]
    cut = bounds[(bounds > 0) & (bounds < n)]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(bounds, s, "right") - 1


def word_hashes(data: np.ndarray, bounds: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, document) of every word, A-Z folded if ``lower``."""
    s, e, d = words(data, bounds)
    sums = range_sums(BYTE[LOWER[data]] if lower else BYTE[data])
    return range_hash(sums, s, e), s, e, d


COEF = [0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F]


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the ``n``-word shingles of every document, in text
    order; a document with fewer words has its whole sequence as one."""
    count = np.bincount(doc, minlength=n_docs)
    ends = np.cumsum(count)
    begins = ends - count
    out_count = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(out_count)])
    if len(h) >= n:
        acc = np.zeros(len(h) - n + 1, U)
        for j in range(n):
            acc += mix(h[j:len(h) - n + 1 + j] + U(COEF[j])) * U(COEF[j])
        full = mix(acc)
        i = np.arange(len(full))
        keep = doc[:len(full)] == doc[n - 1:] if n > 1 else np.ones(len(full), bool)
        full, where = full[keep], doc[i[keep]]
    else:
        full, where = np.zeros(0, U), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        lone = np.array([_sequence(h[begins[k]:ends[k]]) for k in short], U)
        full, where = np.concatenate([full, lone]), np.concatenate([where, short])
        order = np.argsort(where, kind="stable")
        full = full[order]
    return full, out_bounds


def _sequence(h: np.ndarray) -> int:
    x = len(h) * COEF[4]
    for v in h.tolist():
        x = ((x ^ v) * COEF[0] + COEF[1]) & MASK
        x ^= x >> 29
    return int(mix(np.array([x], U))[0])


# ---- packed integer arrays -------------------------------------------------
# Sorted 64-bit keys travel between tasks as byte planes of their differences,
# compressed: about as many bytes as the differences have.

def pack(values: np.ndarray, ordered: bool = False) -> bytes:
    """A non-negative integer array as compressed byte planes (``ordered``: of the
    differences)."""
    import zstandard
    v = np.ascontiguousarray(values).astype(U)
    if ordered and len(v):
        v = np.concatenate([v[:1], np.diff(v)])
    top = int(v.max()) if len(v) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return struct.pack("<IBB", len(v), width, ordered) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(blob: bytes) -> np.ndarray:
    import zstandard
    n, width, ordered = struct.unpack_from("<IBB", blob)
    planes = zstandard.ZstdDecompressor().decompress(blob[6:], max_output_size=max(1, n * width))
    v = np.zeros((n, 8), np.uint8)
    v[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    out = v.reshape(-1).view(U)
    return np.cumsum(out, dtype=U) if ordered else out


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``wanted`` in sorted ``keys`` and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted
