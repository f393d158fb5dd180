"""Content-chosen anchors: every 100-byte window of a text is owned by one of them.

The anchor of a window is the leftmost of its ``GRAM``-byte substrings with the smallest hash. It
depends on the window's bytes alone, so equal windows have equal anchors at equal offsets, and
only windows with a common anchor need to be compared. Neighbouring windows mostly share an
anchor: it stands for the run of windows it owns, whose bytes are its segment.
"""

from __future__ import annotations

import numpy as np

from trawl.llm.text import _VALUE, U64, _pow_table, mix

GRAM = 24
_CHUNK = 1 << 20  # positions that fit in the low bits of a key
_LOW = U64(_CHUNK - 1)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:-(width - span)], x[width - span:]) if width > span else x


def anchors(data: np.ndarray, off: np.ndarray, window: int):
    """(anchor hash, segment hash, document index, first window start, windows owned, offset of the
    anchor in the segment) of all anchors of a block of documents; starts count within documents."""
    width = window - GRAM + 1
    parts = []
    with np.errstate(over="ignore"):
        lo = 0
        while lo + window <= len(data):
            part = data[lo:lo + _CHUNK]
            n = len(part)
            p, inv = _pow_table(n + 1)
            s = np.empty(n + 1, U64)
            s[0] = 0
            np.cumsum(_VALUE[part] * p[:n], out=s[1:])
            gram = mix((s[GRAM:] - s[:-GRAM]) * inv[:n - GRAM + 1])
            key = (gram & ~_LOW) | np.arange(len(gram), dtype=U64)
            at = (_least(key, width) & _LOW).astype(np.int64)  # anchor of each window start
            # windows inside one document
            d = np.searchsorted(off, np.arange(lo, lo + len(at)), "right") - 1 if len(off) > 2 else None
            inside = np.ones(len(at), bool)
            if d is not None:
                inside = np.arange(lo, lo + len(at)) + window <= off[d + 1]
            ok = np.flatnonzero(inside)
            if len(ok):
                a = at[ok]
                cut = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (ok[1:] != ok[:-1] + 1))))
                first, count = ok[cut], np.diff(np.append(cut, len(ok)))
                end = first + count - 1 + window
                seg = (s[end] - s[first]) * inv[first] + (end - first).astype(U64) * U64(0xD6E8FEB86659FD93)
                rel = a[cut] - first
                seg = mix(mix(seg) + rel.astype(U64))
                owner = d[first] if d is not None else np.zeros(len(first), np.int64)
                parts.append((gram[a[cut]], seg, owner, first + lo - off[owner], count, rel))
            if lo + n >= len(data):
                break
            lo += n - window + 1
    if not parts:
        z = np.zeros(0, np.int64)
        return z.astype(U64), z.astype(U64), z, z, z, z
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
