"""Token counts by heap-and-linked-list byte-pair merging (operator 5).

A pre-token starts as one symbol per byte in a doubly linked list; a heap holds its adjacent
mergeable pairs. The lowest-rank pair (leftmost on equal rank) is popped and merged again and
again; the count is the initial symbols minus the merges, no ids are produced. Counts are
remembered per pre-token in a bounded memo, each task counts whole texts on its own, and nothing
is shuffled.

Defined results: a null text counts as empty (0 bytes, 0 tokens); every row of the input gives one
row (repeated or null ids included); other columns are ignored; an empty table gives an empty
result. The added token's string inside a text is one token, as the library's default has it.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from trawl.llm.pretok import Memo, Splitter

_BITS = 20  # of a symbol in a packed pair
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_alphabet() -> dict[str, int]:
    """Printable character that stands for each byte in byte-level vocabularies: visible Latin-1
    characters stand for themselves, the other bytes for U+0100 onwards in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in visible}
    chars.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(visible))})
    return chars


class HeapCounter:
    """Merge rules of a byte-level BPE file (tokenizers' JSON) and counts of texts under them."""

    def __init__(self, path: str, pattern: str, memo: int = 700_000):
        spec = json.load(open(path, encoding="utf-8"))
        vocab = spec["model"]["vocab"]
        self.symbol = {b: vocab[c] for c, b in byte_alphabet().items()}
        self.rule: dict[int, int] = {}  # pair of symbols -> rank and merged symbol, packed
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rule.setdefault(vocab[a] << _BITS | vocab[b], rank << _BITS | vocab[a + b])
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.split = Splitter(pattern)
        self._token = Memo(self.merge_count, memo)
        self._piece = Memo(self._of_piece, memo // 2)

    def merge_count(self, token: str) -> int:
        sym = [self.symbol[b] for b in token.encode()]
        n = count = len(sym)
        if n == 1:
            return 1
        rule, low = self.rule.get, (1 << _BITS) - 1
        heap = [(r >> _BITS) << 32 | i for i in range(n - 1) if (r := rule(sym[i] << _BITS | sym[i + 1])) is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            a, j = sym[i], after[i]
            if a < 0 or j >= n or (r := rule(a << _BITS | sym[j])) is None or r >> _BITS != top >> 32:
                continue  # the pair has changed since it was queued
            sym[i], sym[j] = r & low, -1
            count -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (q := rule((r & low) << _BITS | sym[k])) is not None:
                    heappush(heap, (q >> _BITS) << 32 | i)
            if (h := before[i]) >= 0 and (q := rule(sym[h] << _BITS | (r & low))) is not None:
                heappush(heap, (q >> _BITS) << 32 | h)
        return count

    def _of_piece(self, piece: str) -> int:
        if piece.isascii() and piece.lstrip(" ").isalpha() and piece.count(" ") < 2:
            return self._token[piece]  # one pre-token
        return sum(map(self._token.__getitem__, self.split.findall(piece)))

    def count(self, text: str) -> int:
        parts, total = [text], 0
        for a in self.added:
            if a in text:
                cut = [p.split(a) for p in parts]
                total += sum(len(c) - 1 for c in cut)
                parts = [x for c in cut for x in c]
        return total + sum(sum(map(self._piece.__getitem__, self.split.pieces(p))) for p in parts)


_loaded: dict[tuple, HeapCounter] = {}


def counter(path: str, pattern: str) -> HeapCounter:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = HeapCounter(path, pattern)
    return _loaded[path, pattern]


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) per row of ``docs``."""

    def task(batches):
        c = counter(path, pattern)
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            n = [c.count(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(task, SCHEMA)
