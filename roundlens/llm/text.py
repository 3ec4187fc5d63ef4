"""Byte, word and hash helpers over Arrow string batches (numpy, no per-row Python).

Spark hands tasks whole Arrow batches; :func:`chunks` cuts them to a bounded
number of text bytes so the 8-byte work arrays stay small whatever the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Byte classes of the two word patterns: blanks are space and \t..\r, and
# alphanumeric words keep digits, a-z (after lowering) and every non-ASCII byte.
SPACE_WORD = np.ones(256, dtype=bool)
SPACE_WORD[[32, 9, 10, 11, 12, 13]] = False
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[48:58] = ALNUM_WORD[97:123] = ALNUM_WORD[128:] = True

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_pow_cache: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


@dataclass
class Chunk:
    rows: pa.RecordBatch
    data: np.ndarray      # uint8, texts back to back
    offsets: np.ndarray   # int64, len(rows) + 1
    valid: np.ndarray     # bool per row


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Row slices of the batches with at most ``max_bytes`` of text (one row may exceed it)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        valid = np.asarray(col.is_valid())
        if col.null_count:
            col = pc.fill_null(col, "")
        wide = pa.types.is_large_string(col.type)
        _, off, raw = col.buffers()
        n = len(col)
        offsets = np.frombuffer(off, np.int64 if wide else np.int32)[
            col.offset:col.offset + n + 1].astype(np.int64)
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < n:
            hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
            hi = min(max(hi, lo + 1), n)
            yield Chunk(batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]],
                        offsets[lo:hi + 1] - offsets[lo], valid[lo:hi])
            lo = hi
    pa.default_memory_pool().release_unused()  # workers outlive their tasks


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix) so that sums and sorts see well-spread bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow_cache[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, p in enumerate((_P, _P_INV)):
            x = np.full(size, p, np.uint64)
            x[0] = 1
            _pow_cache[k] = np.cumprod(x)
    return _pow_cache[0], _pow_cache[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums c with hash(data[s:e]) = mix((c[e] - c[s]) * P^-s), see :func:`span_hash`."""
    c = np.zeros(len(data) + 1, np.uint64)
    if len(data):
        v = data.astype(np.uint64)
        v += np.uint64(1)
        v *= _powers(len(data) + 1)[0][:len(data)]
        np.cumsum(v, out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inv = _powers(len(c) + 1)[1]
    return mix((c[end] - c[start]) * inv[start] + (end - start).astype(np.uint64))


def words(chunk: Chunk, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lowered bytes, word starts, word ends, first word of each row + total) of a chunk."""
    data = _LOWER[chunk.data]
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return data, z, z, np.zeros(len(chunk.offsets), np.int64)
    w = is_word[data]
    start = w.copy()
    start[1:] &= ~w[:-1]
    end = w.copy()
    end[:-1] &= ~w[1:]
    edge = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < n)]
    start[edge] |= w[edge]
    end[edge - 1] |= w[edge - 1]
    s = np.flatnonzero(start)
    return data, s, np.flatnonzero(end) + 1, np.searchsorted(s, chunk.offsets)


def word_hashes(chunk: Chunk, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each row + total)."""
    data, s, e, first = words(chunk, is_word)
    return span_hash(prefix_hash(data), s, e), first


_SHINGLE_MULT = [pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(5)]


def shingle_hashes(chunk: Chunk, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every k-word shingle, first shingle of each row + total); rows with
    1..k-1 words give one shingle of the whole sequence."""
    h, first = word_hashes(chunk, SPACE_WORD)
    n = len(h)
    roll = np.zeros(n, np.uint64)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n) if n else np.zeros(0, np.int64)
    for j in range(k):
        m = n - j
        if m <= 0:
            break
        roll[:m] += np.where(left[:m] > j, h[j:], 0).astype(np.uint64) * np.uint64(_SHINGLE_MULT[j])
    # A start counts if its shingle is complete, or if it opens a row shorter than k.
    counts = np.diff(first)
    keep = left >= k
    short = first[:-1][(counts > 0) & (counts < k)]
    keep[short] = True
    roll[short] += left[short].astype(np.uint64)
    per_row = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    return mix(roll[keep]), np.concatenate([[0], np.cumsum(per_row)])
