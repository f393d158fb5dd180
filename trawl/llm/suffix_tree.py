"""Language-model scoring by a probabilistic suffix tree over words (operator 1).

Tokens are lower-cased words and one end per text. Contexts of 0, 1 and 2 tokens are the tree's
states. The root is the smoothed unigram distribution, (c + 0.5) / (N + 0.5 (V + 1)). A longer
context is kept if a divergence test holds: its count times the Kullback-Leibler divergence of its
next-token distribution from that of its longest kept proper suffix is above ``GAIN``. Its entries are
the next tokens seen at least ``LEAST`` times after it, at every size of the input. Its
distribution is smoothed by absolute discounting: P(w|s) = max(c(sw) - 0.5, 0) / c(s) + back(s)
P(w|parent(s)), which sums to one. A token is scored in the longest kept suffix of what precedes it.

The corpus is tokenised once, into a written table of blocks of whole documents: the block's distinct
words and each token's place among them. Counts and sums over the corpus come in rounds. In a round
each block sends what it has of each key (a word, pair or triple, as one 64-bit hash) to the key's
bucket, the bucket adds up, and the block gets back the sums of its own keys, in its own order. A
block sends a key once, so a frequent key is a row's entry per block and no bucket outgrows its share.
A pair is sent only if both of its words were seen ``LEAST`` times in training, a triple only if both
of its pairs were: no other can be seen as often. No table is gathered by the driver.

Defined results: a null or empty text is one end token; rows are scored one by one (repeated or
null ids included; a null id has the fold of the empty text); other columns are ignored; without
training rows every token has probability 0.5 / 0.5 = 1 (score 0); an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Generator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.sample import fold
from trawl.llm.store import persist_alone
from trawl.llm.text import U64, blocks, hashed_words, mix, per_doc

LEAST = 2
GAIN = 12.0
DISCOUNT = 0.5
END = U64(0x5851F42D4C957F2D)
#: Bytes of text in a block, and keys in a bucket at most (on average).
BLOCK = 1 << 21
BUCKET = 1 << 20
#: Rounds of ``_talk``: words, then, for contexts of one and two tokens, counts and the two sums of the test.
ROUNDS = ("word-counts", "pair-counts", "pair-parts", "pair-gains", "triple-counts", "triple-parts", "triple-gains")
OF_WORDS = ROUNDS[0], *ROUNDS[2:4]

_BLOCKS = ("block long, n_tokens long, n_words long, n_train long, doc_id array<long>, held_out array<boolean>, size array<long>, "
           "words binary, codes binary")
_ASKS = "bucket int, block long, keys binary, parts binary"
_REPLIES = "block long, bucket int, n_positive long, sums binary, ids binary"
_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "score double")


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, document index): each document's words and then its end."""
    h, doc, _, _ = hashed_words(data, off)
    n = len(off) - 1
    at = np.searchsorted(doc, np.arange(n), "right")
    return np.insert(h, at, END), np.insert(doc, at, np.arange(n))


def _blocks(rows: DataFrame) -> DataFrame:
    """The tokenised corpus: a row for each block of whole documents."""

    def task(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, off in blocks(batch.column(1), BLOCK):
                tok, doc = _tokens(data, off)
                words, codes = np.unique(tok, return_inverse=True)
                held, size = batch.column(2).slice(lo, hi - lo), per_doc(hi - lo, doc)
                one = [block, len(tok), len(words), int(size[~held.to_numpy(zero_copy_only=False)].sum()),
                       batch.column(0).slice(lo, hi - lo).to_pylist(), held.to_pylist(), size,
                       _ascending(words), _planes(codes.astype("<u4"))]
                types = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())] + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(one, types, strict=True)],
                                                 [x.split()[0] for x in _BLOCKS.split(", ")])
                block += 1

    return rows.mapInArrow(task, _BLOCKS)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its beginning and that of its last token."""
    with np.errstate(over="ignore"):
        return mix(a * U64(0x9E3779B97F4A7C15) + b)


def _planes(x: np.ndarray) -> bytes:
    """The lowest byte of each number, then the next of each: rows of zeros, which compress, for small numbers."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _numbers(x: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind)[:, 0]


def _ascending(keys: np.ndarray) -> bytes:
    return _planes(np.diff(keys, prepend=U64(0)))


def _keys(x: bytes) -> np.ndarray:
    return np.cumsum(_numbers(x, "<u8"), dtype=U64)


def _packed(x: np.ndarray) -> bytes:
    """Numbers as bytes, whole numbers in the smallest type that holds them; the first byte is its letter."""
    whole = not (x % 1).any() and not (x < 0).any()
    x = x.astype(np.min_scalar_type(int(x.max())) if whole else float)
    return x.dtype.char.encode() + x.tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, chr(x[0]), offset=1).astype(float)


def _distinct(h: np.ndarray, *of: np.ndarray) -> tuple[np.ndarray, ...]:
    """(distinct hashes, ascending; the place of each of ``h`` among them; what ``of`` has for each)."""
    keys, inv = np.unique(h, return_inverse=True)
    each = [np.zeros(len(keys), x.dtype) for x in of]
    for x, y in zip(each, of, strict=True):
        x[inv] = y
    return keys, inv, *each


def _level(keys: np.ndarray, n: np.ndarray, mine: np.ndarray, context: np.ndarray, t: np.ndarray,
           own: np.ndarray, q: np.ndarray) -> Generator:
    """The probabilities of entries: ``q``, those in the parent, replaced where the divergence test keeps
    the context. ``keys``, ``n`` (hash, count in training) and ``mine`` are by context; ``context``, ``t`` (count
    in training), ``own`` and ``q`` by entry. ``mine`` and ``own`` are true in one block of the corpus."""
    seen = t >= LEAST
    sums = lambda x: np.bincount(context[seen & own], x[seen & own], len(keys))
    part, back, kept = np.zeros(len(keys)), np.ones(len(keys)), np.zeros(len(keys), bool)
    ask = n >= LEAST
    part[ask] = yield lambda: (keys[ask], sums(2 * (t - DISCOUNT))[ask])
    more = part > 0
    back[more] = 1 - part[more] / 2 / n[more]
    rest = back * np.log(back)  # of the divergence, times the share of the parent that no entry has
    p = np.where(seen, (t - DISCOUNT) / np.maximum(n, 1)[context] + back[context] * q, q)
    gain = lambda: n * (sums(p * np.log(p / q) - q * rest[context]) + np.where(mine, rest, 0))
    got = yield lambda: (keys[more], gain()[more])
    kept[more] = got > 0
    return np.where(kept[context], np.where(seen, p, back[context] * q), q)


def _talk(row: dict, total: int, distinct: int) -> Generator:
    """A block's side of the rounds: yields a function for (hashes of distinct keys, ascending; what to add up) and
    is sent the sums over all blocks, for a count twice the sum and 1 more if the key is this block's own (it is one
    block's), for a gain 1 if the sum is above ``GAIN``, else 0. Returns (tokens that training has, base score,
    score) by document."""
    codes = _numbers(row["codes"], "<u4").astype(np.int64)
    size = np.asarray(row["size"], np.int64)
    doc = np.repeat(np.arange(len(size)), size)
    train = ~np.asarray(row["held_out"], bool)[doc]
    place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)

    if "words" in row:  # the first round, of which later ones have the words' ids
        yield lambda: (_keys(row["words"]), np.bincount(codes, train))
    words = np.concatenate([_keys(x["ids"]) for x in row[ROUNDS[0]]])
    got = np.concatenate([_unpacked(x["sums"]) for x in row[ROUNDS[0]]])
    n, mine = got // 2, got % 2 > 0
    root = (n + 0.5) / (total + 0.5 * (distinct + 1))

    two = np.flatnonzero(place >= 1)
    pair = np.zeros(len(doc), np.int64)
    keys, pair[two], b, c = _distinct(_joined(words[codes[two - 1]], words[codes[two]]), codes[two - 1], codes[two])
    got, of_pairs = np.zeros(len(keys)), (n[b] >= LEAST) & (n[c] >= LEAST)
    got[of_pairs] = yield lambda: (keys[of_pairs], np.bincount(pair[two], train[two], len(keys))[of_pairs])
    t, own = got // 2, got % 2 > 0
    q = yield from _level(words, n, mine, b, t, own, root[c])
    prob = root[codes]
    prob[two] = q[pair[two]]

    at = np.flatnonzero(place >= 2)
    at = at[t[pair[at - 1]] >= LEAST]
    triples, inv, first, last = _distinct(_joined(keys[pair[at - 1]], words[codes[at]]), pair[at - 1], pair[at])
    got, of_triples = np.zeros(len(triples)), t[last] >= LEAST
    got[of_triples] = yield lambda: (triples[of_triples], np.bincount(inv, train[at], len(triples))[of_triples])
    context, of = np.unique(first, return_inverse=True)
    prob[at] = (yield from _level(keys[context], t[context], own[context], of, got // 2, got % 2 > 0, q[last]))[inv]
    known, base, score = (per_doc(len(size), doc, x) for x in (n[codes] > 0, np.log10(root)[codes], np.log10(prob)))
    return known.astype(np.int64), base, score


def _replayed(row: dict, total: int, distinct: int, rounds: int) -> tuple:
    """What the block sends in the round after ``rounds`` (hashes, numbers), or its scores after the last."""
    talk = _talk(row, total, distinct)
    sent = next(talk)
    for name in ROUNDS[1:rounds]:
        got = [_unpacked(x["sums"]) for x in row[name] or ()]
        try:
            sent = talk.send(np.concatenate(got) if got else np.zeros(0))
        except StopIteration as end:
            return end.value
    return sent()


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _asks(state: DataFrame, total: int, distinct: int, rounds: int, bits: int) -> DataFrame:
    """A row for each block and bucket (a key's first ``bits``): the block's keys there, ascending, and its part
    of their sums."""

    def task(batches):
        for row in _rows(batches):
            keys, parts = _replayed(row, total, distinct, rounds)
            if not len(keys):
                continue
            bucket = (keys >> U64(64 - bits)).astype(np.int32) if bits else np.zeros(len(keys), np.int32)
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]]), pa.array(np.full(len(spans), row["block"], np.int64)),
                 pa.array([_ascending(keys[lo:hi]) for lo, hi in spans], pa.binary()),
                 pa.array([_packed(parts[lo:hi]) for lo, hi in spans], pa.binary())], ["bucket", "block", "keys", "parts"])

    return state.mapInArrow(task, _ASKS)


def _replies(asks: DataFrame, name: str, bits: int) -> DataFrame:
    """The sums of each bucket, as ``_talk`` is sent them, dealt back to the blocks that sent the keys; the
    first block owns a key. Words also get ids in the order of their hashes, in the same buckets."""

    def added(asks: pa.Table) -> pa.Table:
        asks = asks.sort_by("block")
        keys = [_keys(x.as_py()) for x in asks["keys"]]
        ends = np.cumsum([len(k) for k in keys])
        distinct, inv = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(inv, np.concatenate([_unpacked(x.as_py()) for x in asks["parts"]]), len(distinct))
        back = (sums > GAIN if name.endswith("gains") else sums)[inv].astype(float)
        if name.endswith("counts"):
            first = np.zeros(len(distinct), np.int64)
            first[inv[::-1]] = np.arange(len(inv))[::-1]
            back *= 2
            back[first] += 1
            if name != ROUNDS[0]:
                back[sums[inv] < LEAST] = 0  # as good as never seen
        ids = inv.astype(U64)
        if bits:
            ids += U64(asks["bucket"][0].as_py()) << U64(64 - bits)
        ids = [_ascending(x) for x in np.split(ids, ends[:-1])] if name == ROUNDS[0] else [None] * len(keys)
        return pa.table([asks["block"], asks["bucket"],
                         pa.array([int((sums > 0).sum())] + [0] * (len(keys) - 1), pa.int64()),
                         pa.array([_packed(x) for x in np.split(back, ends[:-1])], pa.binary()),
                         pa.array(ids, pa.binary())], ["block", "bucket", "n_positive", "sums", "ids"])

    return asks.groupBy("bucket").applyInArrow(added, _REPLIES)


def scores(docs: DataFrame, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document; the
    tree is learnt from the rows outside fold ``held_out``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold() == held_out).alias("held_out"))
    state = persist_alone(_blocks(rows), "blocks")
    row = state.agg(F.sum("n_tokens").alias("n"), F.sum("n_words").alias("words"), F.sum("n_train").alias("train")).first()
    total, distinct = int(row.train or 0), 0
    for k, name in enumerate(ROUNDS):
        bits = (int((row.words if name in OF_WORDS else row.n) or 0) // BUCKET).bit_length()
        replies = _replies(_asks(state, total, distinct, k, bits), name, bits)
        replies = persist_alone(replies.groupBy("block").agg(
            F.sum("n_positive").alias("n_positive"),
            F.sort_array(F.collect_list(F.struct("bucket", "sums", "ids"))).alias(name)), name)
        if not k:
            state = state.drop("words")
            distinct = int(replies.agg(F.sum("n_positive")).first()[0] or 0)
        state = state.join(replies.drop("n_positive"), "block", "left")

    def task(batches):
        for row in _rows(batches):
            known, base, score = _replayed(row, total, distinct, len(ROUNDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_id"], pa.int64()), pa.array(row["held_out"], pa.bool_()),
                 pa.array(row["size"], pa.int64()), pa.array(known), pa.array(np.full(len(known), total)),
                 pa.array(base), pa.array(score)], [x.split()[0] for x in _SCORES.split(", ")])

    return state.mapInArrow(task, _SCORES)
