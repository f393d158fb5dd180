"""Vectorised kernels over Arrow text columns: words, 64-bit word hashes, per-document sums.

A text column is processed in blocks of whole documents (about ``BLOCK`` bytes, a longer document
is a block of its own), straight on the Arrow byte buffer: no Python object per word. A word is a
maximal run of bytes outside ``\\x20\\x09-\\x0D``. Words get a polynomial hash modulo 2**64 with a
random value per byte, finished by a bijective mixer, the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 21
_SPAN = 1 << 22  # bytes hashed at once
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift-multiply rounds)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values for ``seed``."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed * 0x632BE59B))


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUE = stream(1, 256)
_VALUE_LOWER = _VALUE[LOWER]
_powers: dict[str, np.ndarray] = {}


def _pow_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, BLOCK + 1)
        for key, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            a = np.full(size, base, U64)
            a[0] = 1
            _powers[key] = np.multiply.accumulate(a)
    return _powers["p"], _powers["i"]


def range_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Hash of each byte range [start, end) (ranges ascending and disjoint)."""
    out = np.empty(len(starts), U64)
    table = _VALUE_LOWER if lower else _VALUE
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            base = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, base + _SPAN, "right")))
            n = int(ends[j - 1]) - base
            p, inv = _pow_table(n + 1)
            s = np.empty(n + 1, U64)
            s[0] = 0
            np.cumsum(table[data[base:base + n]] * p[:n], out=s[1:])
            a, b = starts[i:j] - base, ends[i:j] - base
            out[i:j] = (s[b] - s[a]) * inv[a] + (b - a).astype(U64) * U64(0xD6E8FEB86659FD93)
            i = j
        return mix(out)


def blocks(column, block: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive whole documents; a null
    text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + block, "right")) - 1)
        j = min(j, n)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document index) of all words; words never cross documents."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    w = ~IS_SPACE[data]
    before = np.empty(len(w), bool)
    before[0] = False
    before[1:] = w[:-1]
    inner = off[1:-1]
    before[inner[inner < len(w)]] = False
    starts = np.flatnonzero(w & ~before)
    after = np.empty(len(w), bool)
    after[-1] = False
    after[:-1] = w[1:]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def hashed_words(data: np.ndarray, off: np.ndarray, lower: bool = True):
    """(word hashes, document index of each word, starts, ends)."""
    starts, ends, doc = word_spans(data, off)
    return range_hash(data, starts, ends, lower), doc, starts, ends


def windows(h: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each ``size``-word window that stays inside a document, index of its first word)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    first = np.flatnonzero(doc[:n] == doc[size - 1:])
    c = stream(7, size) | U64(1)
    with np.errstate(over="ignore"):
        acc = np.zeros(len(first), U64)
        for k in range(size):
            acc = (acc ^ (h[first + k] * c[k])) * U64(0x9FB21C651E98DF25) + c[k]
        return mix(acc), first


def per_doc(n_docs: int, doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Count (int64) or sum (float64) per document index."""
    s = np.bincount(doc, weights, n_docs)
    return s if weights is not None else s.astype(np.int64)
