"""Byte-level BPE encoding by corpus-level merge replay, and decoding (operator 10).

The distinct pre-tokens of a block of documents form a corpus of byte sequences. An inverted index
holds, for each mergeable pair, the words and positions where it stands; the pairs are taken in
rank order, and every occurrence of the pair in the corpus is merged before the next rank, which
updates only the two touched neighbours. The words' ids are remembered in a bounded memo for the
blocks that follow. Each block is handled in its own task, so nothing is shuffled and a lost
executor costs the blocks it held.

Defined results: a null text is empty (0 tokens, hashes of nothing); one row per row of the input;
other columns are ignored; special strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from trawl.llm.pretok import Memo, Splitter

_BITS = 20  # of an id in a packed pair
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Replay:
    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = 450_000):
        self.ranks, self.most = ranks, memo
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pair = Memo(self._pair, 4 * memo)  # rank of two adjacent ids, -1: not mergeable
        self.split = Splitter(pattern)
        self.text_of = {i: b" %d" % i for i in ranks.values()}
        self.words: dict[str, tuple[int, bytes, bytes]] = {}
        self.pieces: dict[str, tuple[int, bytes, bytes]] = {}
        # the generation before: what is used again moves on, the rest is dropped
        self.old_words: dict[str, tuple[int, bytes, bytes]] = {}
        self.old_pieces: dict[str, tuple[int, bytes, bytes]] = {}

    def replay(self, corpus: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of every word of ``corpus``; a word that is itself in the vocabulary is one id."""
        whole = [self.ranks.get(w) for w in corpus]
        words = [w for w, r in zip(corpus, whole, strict=True) if r is None]
        size = np.array([len(w) for w in words], np.int64)
        end = np.cumsum(size)
        flat = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        # places of the whole corpus as linked lists, one per word
        nxt, prv = np.arange(1, len(flat) + 1), np.arange(-1, len(flat) - 1)
        nxt[end - 1], prv[end - size] = -1, -1
        pair = self.pair
        keys, inverse = np.unique((flat[:-1] << _BITS | flat[1:])[nxt[:-1] > 0], return_inverse=True)
        rank = np.array([pair[k] for k in keys.tolist()], np.int64)[inverse]
        at = np.flatnonzero(nxt[:-1] > 0)[rank >= 0]
        rank = rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        rank, at = rank[order], at[order]
        cut = np.flatnonzero(np.concatenate((np.ones(min(len(rank), 1), bool), rank[1:] != rank[:-1])))
        index = {r: x.tolist() for r, x in zip(rank[cut].tolist(), np.split(at, cut[1:]), strict=False)} if len(rank) else {}
        queue = list(index)
        heapify(queue)
        sym, nxt, prv, ends = flat.tolist(), nxt.tolist(), prv.tolist(), end.tolist()
        while queue:
            now = heappop(queue)
            places = index.pop(now, None)
            if places is None:
                continue
            places.sort()
            wait = -1  # end of a word that has a pair of lower rank to go first
            for i in places:
                a = sym[i]
                if a < 0 or (j := nxt[i]) < 0 or pair[a << _BITS | sym[j]] != now:
                    continue  # merged away since it was indexed
                if i < wait:
                    self._add(index, queue, now, i)
                    continue
                sym[i], sym[j] = now, -1
                nxt[i] = k = nxt[j]
                if k >= 0:
                    prv[k] = i
                    if (r := pair[now << _BITS | sym[k]]) >= 0:
                        if (known := index.get(r)) is not None:
                            known.append(i)
                        else:
                            self._add(index, queue, r, i)
                        if r < now:
                            wait = ends[bisect_right(ends, i)]
                if (h := prv[i]) >= 0 and (r := pair[sym[h] << _BITS | now]) >= 0:
                    if (known := index.get(r)) is not None:
                        known.append(h)
                    else:
                        self._add(index, queue, r, h)
                    if r < now:
                        wait = ends[bisect_right(ends, i)]
        ids = iter(zip((end - size).tolist(), ends, strict=True))
        out = []
        for r in whole:
            if r is not None:
                out.append((r,))
            else:
                x, y = next(ids)
                out.append(tuple([t for t in sym[x:y] if t >= 0]))
        return out

    @staticmethod
    def _add(index: dict[int, list[int]], queue: list[int], rank: int, place: int) -> None:
        if rank in index:
            index[rank].append(place)
        else:
            index[rank] = [place]
            heappush(queue, rank)

    def _pair(self, key: int) -> int:
        b = self.bytes_of
        return self.ranks.get(b[key >> _BITS] + b[key & ((1 << _BITS) - 1)], -1)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _cut(self, piece: str) -> list[str]:
        return [piece] if piece.isascii() and piece.lstrip(" ").isalpha() and piece.count(" ") < 2 \
            else self.split.findall(piece)

    @staticmethod
    def _missing(keys: set[str], known: dict, old: dict) -> list[str]:
        """Keys that neither generation of a memo has; those of the old one move to the new."""
        new = []
        for k in keys.difference(known):
            if (v := old.get(k)) is None:
                new.append(k)
            else:
                known[k] = v
        return new

    def learn(self, pieces: list[str]) -> None:
        """Replays the merges over the pre-tokens of ``pieces`` not seen before."""
        if len(self.words) > self.most:
            self.old_words, self.words = self.words, {}
        cut = [(p, self._cut(p)) for p in pieces]
        new = self._missing({t for _, c in cut for t in c}, self.words, self.old_words)
        words, text_of, bytes_of = self.words, self.text_of.__getitem__, self.bytes_of.__getitem__
        for t, ids in zip(new, self.replay([t.encode() for t in new]), strict=True):
            words[t] = (len(ids), b"".join(map(text_of, ids)), b"".join(map(bytes_of, ids)))
        for p, c in cut:
            if len(c) == 1:
                self.pieces[p] = words[c[0]]
            else:
                got = [words[t] for t in c]
                self.pieces[p] = (sum(x[0] for x in got), b"".join([x[1] for x in got]), b"".join([x[2] for x in got]))

    def split_all(self, texts: list[str]) -> list[list[str]]:
        """Pieces of every text; ``self.pieces`` has (tokens, ids as text, decoded bytes) of each."""
        if len(self.pieces) > self.most:
            self.old_pieces, self.pieces = self.pieces, {}
        cut = [self.split.pieces(t) for t in texts]
        new: set[str] = set()
        for c in cut:
            new.update(c)
        self.learn(self._missing(new, self.pieces, self.old_pieces))
        return cut

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [[int(i) for p in c for i in self.pieces[p][1].split()] for c in self.split_all(texts)]


_loaded: dict[tuple, Replay] = {}


def replayer(path: str, pattern: str) -> Replay:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Replay(read_ranks(path), pattern)
    return _loaded[path, pattern]


def encode_ids(docs: DataFrame, path: str, pattern: str, group: int = 1024) -> DataFrame:
    """doc_id, ids (array<int>) and decoded (binary) of every row: the operator's real output."""

    def task(batches):
        r = replayer(path, pattern)
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            for i in range(0, len(texts), group):
                ids = r.encode(texts.slice(i, group).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, group), pa.array(ids, pa.list_(pa.int32())),
                     pa.array([r.decode(x) for x in ids], pa.binary())], ["doc_id", "ids", "decoded"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        task, "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str, group: int = 2048) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ids and decoded bytes of each piece come from
    the replay once and are joined per document."""

    def task(batches):
        r = replayer(path, pattern)
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            for i in range(0, len(texts), group):
                n, a, d = [], [], []
                for cut in r.split_all(texts.slice(i, group).to_pylist()):
                    got = [r.pieces[p] for p in cut]
                    n.append(sum(x[0] for x in got))
                    a.append(hashlib.sha256(b"".join([x[1] for x in got])[1:]).hexdigest())
                    d.append(hashlib.sha256(b"".join([x[2] for x in got])).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, group), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                     pa.array(d, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(task, DIGEST_SCHEMA)
