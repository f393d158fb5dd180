"""Exact per-document statistics of words, lines and repeated windows, vectorised."""

from __future__ import annotations

import numpy as np

from trawl.llm.text import U64, blocks, hashed_words, mix, per_doc, range_hash, windows

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b".,;:!?")] = True
_CONT = (np.arange(256) & 0xC0) == 0x80

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "mean_word_chars", "symbol_share", "dup_line_share", "repeat_share",
            "upper_share", "digit_share", "punct_per_word", "distinct_share", "same_as_previous",
            "words_per_line", "bar_word_share", "top_word_share")
#: +1: more can only raise the keep score; -1: more can only lower it; 0: free.
MONOTONE = (0, 0, -1, -1, -1, -1, 0, 0, 0, -1, 0, -1, 0)


def _in_doc(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h ^ (doc.astype(U64) * U64(0xA24BAED4963EE407) + U64(1)))


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, start of each run of equal keys in the order, run lengths)."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    new = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    return order, new, np.diff(np.append(new, len(s)))


def _block(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(off) - 1
    h, doc, starts, ends = hashed_words(data, off, lower=False)
    words = per_doc(n, doc)
    csum = lambda mask: np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    in_docs = lambda c: c[off[1:]] - c[off[:-1]]
    cont = csum(_CONT[data])
    chars = np.zeros(n, np.int64)
    if len(starts):
        chars = per_doc(n, doc, (ends - starts) - (cont[ends] - cont[starts])).astype(np.int64)
    symbols, upper, digit, punct = (in_docs(csum(m[data])) for m in (_SYMBOL, _UPPER, _DIGIT, _PUNCT))

    # lines with a word: split at \n and at document ends
    cuts = np.unique(np.concatenate((off, np.flatnonzero(data == 10) + 1))) if len(data) else off[:1]
    a, b = cuts[:-1], cuts[1:].copy()
    if len(a):
        b[data[b - 1] == 10] -= 1
        full = np.searchsorted(starts, b) > np.searchsorted(starts, a)
        a, b = a[full], b[full]
    line_doc = np.searchsorted(off, a, "right") - 1
    lines = per_doc(n, line_doc)
    order, new, _ = _runs(_in_doc(range_hash(data, a, b, False), line_doc))
    dup = lines - per_doc(n, line_doc[order[new]])

    wh, first = windows(h, doc, 5)
    order, new, size = _runs(_in_doc(wh, doc[first]))
    twice = np.repeat(size >= 2, size)
    mark = np.zeros(len(h) + 1, np.int64)
    hit = first[order[twice]]
    np.add.at(mark, hit, 1)
    np.add.at(mark, hit + 5, -1)
    repeat = per_doc(n, doc[np.cumsum(mark)[:-1] > 0])

    order, new, size = _runs(_in_doc(h, doc))
    distinct = per_doc(n, doc[order[new]])
    top = np.zeros(n, np.int64)
    if len(new):
        np.maximum.at(top, doc[order[new]], size)
    same = per_doc(n, doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])]) if len(h) > 1 else np.zeros(n, np.int64)
    bar = per_doc(n, doc[(ends - starts == 1) & (data[starts] == ord("|"))]) if len(h) else np.zeros(n, np.int64)

    counts = np.stack([words, chars, symbols, dup, repeat], 1)
    w, c, ln = (np.maximum(x, 1).astype(float) for x in (words, chars, lines))
    feats = np.stack([np.log1p(words), chars / w, symbols / c, dup / ln, repeat / w, upper / c, digit / c,
                      punct / w, distinct / w, same / w, words / ln, bar / w, top / w], 1)
    return counts, feats


def document_stats(column) -> tuple[np.ndarray, np.ndarray]:
    """(counts int64 [n, 5], features float [n, 13]) of an Arrow text column; null is empty."""
    parts = [_block(data, off) for _, _, data, off in blocks(column)]
    if not parts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
