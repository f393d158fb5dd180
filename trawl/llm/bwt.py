"""Burrows-Wheeler transforms of small shards and their merge by interleave refinement.

Strings are read cyclically. A shard's transform lists, in the order of its suffixes' first
``depth`` bytes, the ``step`` bytes before each suffix. Two shards are merged without sorting
their suffixes again: the interleave (one shard mark per merged place) starts as all of the first,
then all of the second; each round moves every mark to the place its preceding bytes give it, by a
stable distribution on those bytes, after which the interleave is right for ``step`` more bytes. The
places where a round begins a new block tell the length of the common prefix there; blocks left
after ``depth`` bytes are the repeated intervals.
"""

from __future__ import annotations

import numpy as np


class Strings:
    """Concatenated strings with codes of the bytes that start at every place: ``wide`` bytes at a
    time, and ``rest`` once to make up ``depth``. Codes are ranks of byte strings in 16 bits; the
    width is the largest whose distinct byte strings fit."""

    def __init__(self, parts: list[bytes], depth: int):
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts], np.int64)
        self.offsets = np.cumsum(size) - size
        self.string = np.repeat(np.arange(len(parts)), size)
        self.first, self.size = self.offsets[self.string], size[self.string]
        self.rel = np.arange(len(self.data)) - self.first
        for wide in (8, 4, 2):
            code = self._code(wide)
            if code is not None:
                break
        self.widths = [depth % wide] * bool(depth % wide) + [wide] * (depth // wide)
        self.code = {wide: code} | {w: self._code(w) for w in set(self.widths) - {wide}}

    def _code(self, width: int) -> np.ndarray | None:
        code = self.data.astype(np.uint64)
        for k in range(1, width):
            code = (code << np.uint64(8)) | self.data[self.at(k)]
        if width > 2:
            values, code = np.unique(code, return_inverse=True)
            if len(values) > 1 << 16:
                return None
        return code.astype(np.uint16)

    def at(self, k: int, places=slice(None)) -> np.ndarray:
        """Place ``k`` bytes after (before, if negative) each of ``places``, cyclically."""
        r, size = self.rel[places] + k, self.size[places]
        over = (r >= size) | (r < 0)
        if over.any():
            r[over] %= size[over]
        return self.first[places] + r

    def shard(self, places: np.ndarray) -> np.ndarray:
        """``places`` sorted by their first ``depth`` bytes."""
        order, k = places, sum(self.widths)
        for w in self.widths:
            k -= w
            order = order[np.argsort(self.code[w][self.at(k, order)], kind="stable")]
        return order

    def before(self, order: np.ndarray, width: int) -> np.ndarray:
        """The transform: code of the bytes before each suffix."""
        return self.code[width][self.at(-width, order)]


def merge(s: Strings, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(merged order, bytes known to be shared with the place before; the depth: all of them)."""
    transforms = {w: np.concatenate((s.before(left, w), s.before(right, w))) for w in set(s.widths)}
    n, depth = len(left) + len(right), sum(s.widths)
    z = np.zeros(n, bool)
    z[len(left):] = True
    block = np.zeros(n, np.int32)
    prefix = np.full(n, depth, np.int16)
    done = 0
    for width in s.widths:
        ones = np.cumsum(z)
        sym = transforms[width][np.where(z, len(left) - 1 + ones, np.arange(n) - ones)]
        order = np.argsort(sym, kind="stable")
        z, sym, old = z[order], sym[order], block[order]
        new = np.ones(n, bool)
        new[1:] = (sym[1:] != sym[:-1]) | (old[1:] != old[:-1])
        prefix[new & (prefix == depth)] = done
        block = np.cumsum(new, dtype=np.int32)
        done += width
    ones = np.cumsum(z)
    return np.where(z, right[ones - 1], left[np.minimum(np.arange(n) - ones, len(left) - 1)]), prefix


def repeated(parts: list[bytes], windows: np.ndarray, depth: int, shards: int = 2):
    """(string, window start) of every window of ``depth`` bytes that equals one of an earlier
    string (strings are in order of precedence; ``windows[i]`` starts of string i count)."""
    none = np.zeros(0, np.int64)
    if len(parts) < 2:
        return none, none
    s = Strings(parts, depth)
    n = len(parts)
    cuts = sorted({n * k // shards for k in range(shards)})
    bounds = [*(int(s.offsets[c]) for c in cuts), len(s.data)]
    orders = [s.shard(np.arange(a, b)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    while len(orders) > 1:
        left, right, *orders = orders
        order, prefix = merge(s, left, right)
        orders.append(order)
    interval = np.cumsum(prefix < depth)
    ours = np.flatnonzero(s.rel[order] < windows[s.string[order]])
    order, interval = order[ours], interval[ours]
    # the first string of each interval keeps its window
    rank = np.lexsort((order, interval))
    order, interval = order[rank], interval[rank]
    at = order[1:][interval[1:] == interval[:-1]]
    return s.string[at], s.rel[at]
