"""Packing by concatenate and cut (operator 7).

Pass 1 tokenises each partition of documents once, gives every document its start inside the
partition, and writes the ids (two bytes each where the vocabulary allows) to a table. The
partitions' token totals, one row per partition, are turned into global offsets by prefix sums;
that table's size is bounded by the number of partitions, and it is broadcast. Pass 2 reads the
written ids where they lie, without a shuffle, and cuts the global stream into fixed windows of
``window`` ids; a document that crosses a window's end gives one boundary record more. Only the
last sequence can hold padding.

Defined results: a null text is empty and so is one end id; repeated rows are packed as often as
they occur; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.heap_bpe import byte_alphabet
from trawl.llm.store import persist

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")


class Ids:
    """Ids of whole texts as the ``tokenizers`` file at ``path`` gives them.

    Where every merge's id follows the merge order, the merges are ranks and ``tiktoken`` runs the
    same vocabulary several times faster (tests hold it against ``tokenizers``); any other file is
    run by ``tokenizers`` itself.
    """

    def __init__(self, path: str, pattern: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.kind = np.dtype("<u2") if max([*vocab.values(), *added.values()]) < 1 << 16 else np.dtype("<u4")
        joined = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        plain = {t: i for t, i in vocab.items() if t not in added}
        alphabet = byte_alphabet()
        if joined == sorted(plain.values())[-len(joined):] and spec["normalizer"] is None:
            import tiktoken

            ranks = {bytes(alphabet[c] for c in t): i for t, i in plain.items()}
            lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
            self.of = lambda text: np.asarray(lib.encode_to_numpy(text, allowed_special="all"), self.kind)
        else:
            from tokenizers import Tokenizer

            lib = Tokenizer.from_file(path)
            self.of = lambda text: np.array(lib.encode(text, add_special_tokens=False).ids, self.kind)


_loaded: dict[tuple, Ids] = {}


def _ids(path: str, pattern: str) -> Ids:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Ids(path, pattern)
    return _loaded[path, pattern]


def tokenised(docs: DataFrame, path: str, pattern: str, end_id: int = 0, group: int = 256) -> DataFrame:
    """part, doc_id, first (ids of the partition before it), n_ids, ids per row of ``docs``."""

    def task(batches):
        from pyspark import TaskContext

        lib, part, done = _ids(path, pattern), TaskContext.get().partitionId(), 0
        end = np.array([end_id], lib.kind).tobytes()
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            for i in range(0, len(texts), group):
                ids = [lib.of(t).tobytes() + end for t in texts.slice(i, group).to_pylist()]
                n = np.array([len(x) // lib.kind.itemsize for x in ids], np.int64)
                upto = done + np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), b.column(0).slice(i, group), pa.array(upto - n),
                     pa.array(n), pa.array(np.full(len(n), lib.kind.itemsize, np.int32)), pa.array(ids, pa.binary())],
                    ["part", "doc_id", "first", "n_ids", "width", "ids"])
                done = int(upto[-1])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        task, "part int, doc_id long, first long, n_ids long, width int, ids binary")


def _cut(window: int):
    def task(batches):
        for b in batches:
            d = b.to_pydict()
            rows = []
            for doc, first, n, width, ids in zip(d["doc_id"], d["at"], d["n_ids"], d["width"], d["ids"], strict=True):
                a = np.frombuffer(ids, "<u2" if width == 2 else "<u4").astype("<u4")
                start = 0
                while start < n:
                    seq, at = divmod(first + start, window)
                    k = min(window - at, n - start)
                    rows.append((doc, start, k, zlib.crc32(a[start:start + k]), n, seq, at))
                    start += k
            cols = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                              "sequence_id", "offset"])
    return task


def pack(docs: DataFrame, path: str, pattern: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    ids = persist(tokenised(docs, path, pattern, end_id), "ids")
    totals = ids.groupBy("part").agg(F.max(F.col("first") + F.col("n_ids")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = ids.join(F.broadcast(offsets), "part").select(  # one row per partition of pass 1
        "doc_id", (F.col("first") + F.col("base")).alias("at"), "n_ids", "width", "ids")
    return placed.mapInArrow(_cut(window), PIECE_SCHEMA)
