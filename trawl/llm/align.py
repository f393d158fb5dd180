"""Alignment of two tokenisations of the same text (operator 13): a byte-level BPE (A) and a
SentencePiece model (B).

Both token lists of a text are turned into ascending lists of byte end offsets. The shorter list
drives a galloping search into the longer one: from the place of the driver before, a stride doubles
until it reaches the driver's end, then a binary search closes the bracket. Ends found in both lists
are the borders of groups; the differences of neighbouring ranks are, for each token, the range of
tokens of the other list that its bytes overlap.

Links (overlapping token occurrences) never leave a text as rows: a text's row carries its distinct
id pairs and how often each is linked, and the corpus counts are one aggregation over them. To look
the counts up again, pairs that hold more than one ``HOT``-th of all links are broadcast (at most
``HOT`` of them, at any size of corpus); the pairs beyond are joined by a shuffle.

Defined results: a null or empty text, and one whose joined A or B bytes differ from space + text,
has no tokens: zeros and an empty digest; such texts add nothing to the counts. Repeated rows are
texts of their own, a null id stays null, other columns are ignored, an empty table gives an empty
result. Ties for the highest count of a B id all count as highest.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.heap_bpe import byte_alphabet
from trawl.llm.store import persist

#: Pairs above one HOT-th of all links are broadcast: at most this many (16 bytes each).
HOT = 1_000_000
_ROW = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<int>")
_GROUPS = "doc_id long, row long, groups array<struct<a:array<int>,b:array<int>>>"


def gallop(drivers: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Rank of each ascending driver in ``longer`` (ascending): how many of its values are smaller."""
    ends = longer.tolist()
    size, at, ranks = len(ends), 0, []
    for x in drivers.tolist():
        if at < size and ends[at] < x:
            low = high = at + 1
            step = 1
            while high < size and ends[high] < x:  # the stride doubles until it reaches the driver
                low = high + 1
                high += step
                step += step
            at = low if low >= high else bisect_left(ends, x, low, min(high, size))
        ranks.append(at)
    return np.array(ranks, np.int64)


def overlaps(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For two lists of ends of the same bytes: per token of ``short`` the first token of ``long`` it
    overlaps and how many, and whether its end is an end of ``long`` too."""
    rank = gallop(short, long)
    common = long[np.minimum(rank, len(long) - 1)] == short if len(long) else np.zeros(len(short), bool)
    first = np.zeros(len(short), np.int64)
    first[1:] = (rank + common)[:-1]
    return first, rank - first + 1, common


class ByteBpe:
    """A byte-level BPE file of ``tokenizers``: ids of a text in which the strings of special tokens
    are plain text, and the bytes of each id.

    Where every merge's id follows the merge order, the merges are ranks and ``tiktoken`` runs the
    same vocabulary; any other file is run by ``tokenizers`` itself.
    """

    def __init__(self, path: str, pattern: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        added = {t["content"] for t in spec.get("added_tokens", [])}
        plain = {t: i for t, i in vocab.items() if t not in added}
        alphabet = byte_alphabet()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in plain.items():
            self.bytes[i] = bytes(alphabet[c] for c in t)
        joined = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        if joined == sorted(plain.values())[-len(joined):] and spec["normalizer"] is None:
            import tiktoken

            lib = tiktoken.Encoding("own", pat_str=pattern, special_tokens={},
                                    mergeable_ranks={self.bytes[i]: i for i in plain.values()})
            self.ids, self.spelt = lib.encode_ordinary, lib.decode_bytes
        else:
            from tokenizers import Tokenizer

            lib = Tokenizer.from_file(path)
            lib.encode_special_tokens = True
            self.ids = lambda text: lib.encode(text, add_special_tokens=False).ids
            self.spelt = lambda ids: b"".join(map(self.bytes.__getitem__, ids))
        self.length = np.array([len(b) for b in self.bytes], np.int64)


class Pieces:
    """A SentencePiece model: ids of a text and the bytes of each id (U+2581 as space, byte pieces as
    their byte)."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids = lambda text: lib.encode(text, num_threads=1)
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(names)]
        self.spelt = lambda ids: b"".join(map(self.bytes.__getitem__, ids))
        self.length = np.array([len(b) for b in self.bytes], np.int64)


_loaded: dict[tuple, tuple[ByteBpe, Pieces]] = {}


def _libraries(bpe: str, pattern: str, pieces: str) -> tuple[ByteBpe, Pieces]:
    key = (bpe, pattern, pieces)
    if key not in _loaded:
        _loaded[key] = ByteBpe(bpe, pattern), Pieces(pieces)
    return _loaded[key]


_strings: list[str] = []


def _spelt(n: int) -> list[str]:
    """Each of at least ``n`` ids in decimal with what may follow it: a comma, the bar after a group's
    last A id, the semicolon after its last B id."""
    _strings.extend(f"{i}{c}" for i in range(len(_strings) // 3, n) for c in ",|;")
    return _strings


class Alignment:
    """Both tokenisations of one text with their links and groups; no tokens where they do not
    spell space + text."""

    def __init__(self, text: str | None, a: ByteBpe, b: Pieces):
        spelt = (" " + (text or "")).encode()
        ids_a, ids_b = (a.ids(" " + text), b.ids(text)) if text else ([], [])
        if a.spelt(ids_a) != spelt or b.spelt(ids_b) != spelt:
            ids_a = ids_b = []
        self.a, self.b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(a.length[self.a]), np.cumsum(b.length[self.b])
        swap = len(ends_b) < len(ends_a)
        first, count, common = overlaps(ends_b, ends_a) if swap else overlaps(ends_a, ends_b)
        mine = np.repeat(np.arange(len(first)), count)
        other = np.arange(len(mine)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        self.links = (other, mine) if swap else (mine, other)
        cut, rank = np.flatnonzero(common), (first + count - 1)[common]
        self.cut_a, self.cut_b = ((rank, cut) if swap else (cut, rank))  # last token of each group

    def groups(self) -> list[tuple[list[int], list[int]]]:
        """(A ids, B ids) of each group."""
        out, i, j = [], 0, 0
        a, b = self.a.tolist(), self.b.tolist()
        for x, y in zip(self.cut_a.tolist(), self.cut_b.tolist(), strict=True):
            out.append((a[i:x + 1], b[j:y + 1]))
            i, j = x + 1, y + 1
        return out

    def written(self) -> str:
        """``a1,a2|b1;a3|b2,b3``: decimal ids in order (each id's string with what follows it is
        looked up, A and B tokens interleaved by group)."""
        n = len(self.a) + len(self.b)
        if not n:
            return ""
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.cut_a] = last_b[self.cut_b] = 1
        in_a, in_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # group of each token
        code = np.empty(n, np.int64)
        code[np.arange(len(self.a)) + np.concatenate([[0], self.cut_b + 1])[in_a]] = 3 * self.a + last_a
        code[np.arange(len(self.b)) + (self.cut_a + 1)[in_b]] = 3 * self.b + 2 * last_b
        return "".join(map(_spelt(int(code.max()) // 3 + 1).__getitem__, code.tolist()))[:-1]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked id pairs (A id shifted by 32 bits, plus B id) and their links."""
        i, j = self.links
        return np.unique(self.a[i] << 32 | self.b[j], return_counts=True)


def _lists(rows: list, kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).astype(kind)))


def aligned(docs: DataFrame, bpe: str, pattern: str, pieces: str, group: int = 128) -> DataFrame:
    """One row per document: counts, digest, distinct pairs with their links in it."""

    def task(batches):
        a, b = _libraries(bpe, pattern, pieces)
        for batch in batches:
            for s in range(0, batch.num_rows, group):
                part = batch.slice(s, group)
                got = [Alignment(t, a, b) for t in part.column(1).to_pylist()]
                pairs = [g.pairs() for g in got]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(g.a) for g in got], pa.int64()),
                     pa.array([len(g.b) for g in got], pa.int64()), pa.array([len(g.cut_a) for g in got], pa.int64()),
                     pa.array([len(g.links[0]) for g in got], pa.int64()),
                     pa.array([hashlib.sha256(g.written().encode()).hexdigest() if len(g.a) else "" for g in got]),
                     _lists([p for p, _ in pairs], np.int64), _lists([n for _, n in pairs], np.int32)],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(task, _ROW)


def groups(docs: DataFrame, bpe: str, pattern: str, pieces: str, span: int = 512) -> DataFrame:
    """The groups themselves: ``doc_id``, ``row`` (of the text's spans of ``span`` groups, from 0) and
    ``groups`` in order; a text without tokens gives no row."""

    def task(batches):
        a, b = _libraries(bpe, pattern, pieces)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = Alignment(text.as_py(), a, b).groups()
                for k in range(0, len(got), span):
                    rows = [{"a": x, "b": y} for x, y in got[k:k + span]]
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": doc, "row": k // span, "groups": rows}],
                        pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("groups", pa.list_(pa.struct(
                            [("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))]))

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(task, _GROUPS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, total (links of the corpus that hold it), best (whether it is its B id's highest)."""
    each = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counts = persist(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("total")), "pairs")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    top = counts.groupBy(b.alias("b")).agg(F.max("total").alias("top"))
    # one row per B id: bounded by the vocabulary
    return counts.withColumn("b", b).join(F.broadcast(top), "b").select(
        "pair", "total", (F.col("total") == F.col("top")).alias("best"))


def align(docs: DataFrame, bpe: str, pattern: str, pieces: str, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = persist(aligned(docs, bpe, pattern, pieces).withColumn("key", F.monotonically_increasing_id()), "aligned")
    counts = persist(pair_counts(rows), "counts")
    links = counts.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    often = F.col("total") * hot > links  # fewer than ``hot`` pairs can be so
    each = rows.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "key", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    some = each.join(F.broadcast(counts.where(often)), "pair", "left")
    known, rest = some.where(F.col("total").isNotNull()), some.where(F.col("total").isNull()).select("key", "pair", "times")
    if counts.where(~often).limit(1).count():
        known = known.unionByName(rest.join(counts.where(~often).hint("merge"), "pair"))
    sums = known.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                    F.sum(F.col("times") * F.col("total")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(sums, "key", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
