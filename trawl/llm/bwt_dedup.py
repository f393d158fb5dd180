"""Exact removal of repeated byte passages by merged Burrows-Wheeler transforms (operator 3).

1. Every text is cut into the windows its anchors own (``anchors``). Occurrences of a segment (an
   anchor's run of windows with its bytes) that come after another in the same task are repeats
   already; the first of each task goes, as hashes only, to the bucket of its anchor.
2. A bucket's segments are sorted by class (equal bytes) and document order and streamed: all but
   the first of a class are repeats. If a bucket has several classes, their first members may
   still share part of their windows.
3. Those members are sent, as bytes, to where anchor and 38 bytes on the left (or right) of it are
   the same: two equal windows agree on one of the two. Places with two or more of them are
   gathered in bounded shards whose transforms are merged by interleave refinement
   (``bwt.merge``); the repeated intervals of the merged transform tell the windows that occur
   before. Buckets with over ``HOT`` classes are dealt out window by window instead.
4. The repeated windows of a document are united into spans, and the rest of its bytes is kept.

A document is known by id and a 64-bit hash of its text. Lists of places and spans are broadcast if
they are under ``BROADCAST_BYTES`` in memory, joined by a shuffle otherwise.

Defined results: a null text is empty (0 bytes, hash of nothing); a null id comes before all
others; rows with equal id and text count as one document and get the same result; documents under
``window`` bytes lose nothing; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.anchors import GRAM, anchors
from trawl.llm.bwt import repeated
from trawl.llm.store import persist
from trawl.llm.text import U64, blocks

HOT = 20_000
BROADCAST_BYTES = 96 << 20
_SHARE_BLOCK = 1 << 19
_FIRST = -(1 << 63)  # a null id
_REPEAT, _CHECK, _HOT = 0, 1, 2


def _keyed(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``columns`` with the id that orders documents and the hash that tells equal ids apart."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("rid"), *columns)


def _segments(keyed: DataFrame, window: int) -> DataFrame:
    """Rows (kind, h, s, id, rid, pos, size) of all anchors; kind 1 rows are repeats inside the task."""

    def out(kind, h, s, i, r, pos, size):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(h), kind, np.int32)), pa.array(h), pa.array(s), pa.array(i), pa.array(r), pa.array(pos),
             pa.array(size)], ["kind", "h", "s", "id", "rid", "pos", "size"])

    def task(batches):
        for b in batches:
            held = []
            ids, rid = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for lo, _, data, off in blocks(b.column(2), _SHARE_BLOCK):
                g, s, d, first, n, rel = anchors(data, off, window)
                held.append((g >> U64(16), s, ids[d + lo], rid[d + lo], first.astype(np.int32), (n << 8 | rel).astype(np.int32)))
            if not held:
                continue
            h, s, i, r, pos, size = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((pos, r, i, s))
            h, s, i, r, pos, size = h[order].view(np.int64), s[order].view(np.int64), i[order], r[order], pos[order], size[order]
            # a row given twice is one occurrence
            once = np.ones(len(s), bool)
            once[1:] = (s[1:] != s[:-1]) | (i[1:] != i[:-1]) | (r[1:] != r[:-1]) | (pos[1:] != pos[:-1])
            h, s, i, r, pos, size = (x[once] for x in (h, s, i, r, pos, size))
            again = np.zeros(len(s), bool)
            again[1:] = s[1:] == s[:-1]
            yield out(0, *(x[~again] for x in (h, s, i, r, pos, size)))
            if again.any():  # dealt by document
                yield out(1, r[again] ^ i[again], *(x[again] for x in (s, i, r, pos, size)))

    return keyed.select("id", "rid", "text").mapInArrow(
        task, "kind int, h long, s long, id long, rid long, pos int, size int")


def _judged(segments: DataFrame) -> DataFrame:
    """(kind, id, rid, pos, size, h): repeats, members to check, and anchors of hot buckets."""
    dealt = segments.repartition(F.col("h")).sortWithinPartitions("kind", "h", "s", "id", "rid", "pos")

    def task(batches):
        last_h = last_s = last_at = None
        classes, pending = 0, None

        def out(kind, i, r, pos, size, h):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), kind, np.int32)), pa.array(i), pa.array(r), pa.array(pos), pa.array(size),
                 pa.array(h)],
                ["kind", "id", "rid", "pos", "size", "h"])

        for b in batches:
            if not len(b):
                continue
            kind, h, s, i, r, pos, size = (b.column(k).to_numpy() for k in range(7))
            local = kind == 1
            if local.any():
                yield out(_REPEAT, i[local], r[local], pos[local], size[local], h[local])
                h, s, i, r, pos, size = (x[~local] for x in (h, s, i, r, pos, size))
                if not len(h):
                    continue
            new_h, new_s = np.ones(len(h), bool), np.ones(len(h), bool)
            new_h[1:], new_s[1:] = h[1:] != h[:-1], s[1:] != s[:-1]
            new_h[0], new_s[0] = h[0] != last_h, h[0] != last_h or s[0] != last_s
            new_s |= new_h
            twice = np.zeros(len(h), bool)  # the same occurrence from two tasks
            twice[1:] = ~new_s[1:] & (i[1:] == i[:-1]) & (r[1:] == r[:-1]) & (pos[1:] == pos[:-1])
            twice[0] = not new_s[0] and last_at == (i[0], r[0], pos[0])
            # a row given several times as the first of its class is not a repeat of itself
            again = ~new_s & ~twice
            yield out(_REPEAT, i[again], r[again], pos[again], size[again], h[again])
            bucket = np.cumsum(new_h)  # 0: the bucket carried over
            n = np.bincount(bucket, new_s, bucket[-1] + 1).astype(np.int64)
            n[0] += classes if not new_h[0] else 0
            if pending is not None and not new_h[0] and n[0] > 1:
                yield out(_CHECK, *pending)
                pending = None
            check = new_s & (n[bucket] > 1)
            yield out(_CHECK, i[check], r[check], pos[check], size[check], h[check])
            hot = np.flatnonzero(new_h & (n[bucket] > HOT)) if n.max() > HOT else []
            if n[0] > HOT and not new_h[0]:
                hot = np.append(hot, 0).astype(np.int64)
            if len(hot):
                yield out(_HOT, i[hot], r[hot], pos[hot], size[hot], h[hot])
            last_h, last_s, last_at, classes = h[-1], s[-1], (i[-1], r[-1], pos[-1]), n[bucket[-1]]
            if classes == 1:
                if new_s[bucket == bucket[-1]].any():
                    f = np.flatnonzero(new_s)[-1:]
                    pending = (i[f], r[f], pos[f], size[f], h[f])
            else:
                pending = None

    return dealt.mapInArrow(task, "kind int, id long, rid long, pos int, size int, h long")


def _bounded(df: DataFrame, bytes_: int) -> DataFrame:
    return F.broadcast(df) if bytes_ <= BROADCAST_BYTES else df


def _sent(keyed: DataFrame, judged: DataFrame, window: int) -> DataFrame:
    """(key, id, rid, pos, n, bytes): the windows of members to check, where they may meet others."""
    side = (window - GRAM) // 2
    hot = judged.where(F.col("kind") == _HOT).select("h").distinct().withColumn("hot", F.lit(True))
    check = judged.where(F.col("kind") == _CHECK)
    if hot.head(1):
        check = check.join(_bounded(hot, 80 * hot.count()), "h", "left")  # at most rows / HOT anchors
    else:
        check = check.withColumn("hot", F.lit(False))
    n, d = check.agg(F.count("*"), F.approx_count_distinct(F.xxhash64("id", "rid"))).first()
    lists = check.groupBy("id", "rid").agg(F.collect_list(F.struct(
        F.col("pos").alias("at"), "size", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("todo"))
    rows = keyed.join(_bounded(lists, 40 * n + 160 * d), ["id", "rid"]).select("id", "rid", "text", "todo")

    def task(batches):
        hash_ = xxhash.xxh3_64_intdigest
        for b in batches:
            key, ids, rids, pos, size, seg = [], [], [], [], [], []
            for i, r, text, todo in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = text.encode()
                for t in todo:
                    at, count, rel = t["at"], t["size"] >> 8, t["size"] & 255
                    if t["hot"]:
                        for p in range(at, at + count):
                            w = data[p:p + window]
                            key.append(hash_(w))
                            ids.append(i)
                            rids.append(r)
                            pos.append(p)
                            size.append(1)
                            seg.append(w)
                        continue
                    a = at + rel
                    left = min(max(a - side - at + 1, 0), count)  # windows with enough on the left
                    if left:
                        key.append(hash_(data[a - side:a + GRAM]))
                        ids.append(i)
                        rids.append(r)
                        pos.append(at)
                        size.append(left)
                        seg.append(data[at:at + left - 1 + window])
                    if left < count:
                        key.append(hash_(data[a:a + GRAM + side], 1))
                        ids.append(i)
                        rids.append(r)
                        pos.append(at + left)
                        size.append(count - left)
                        seg.append(data[at + left:at + count - 1 + window])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(key, U64).view(np.int64)), pa.array(ids, pa.int64()), pa.array(rids, pa.int64()), pa.array(pos, pa.int32()),
                 pa.array(size, pa.int32()), pa.array(seg, pa.binary())], ["key", "id", "rid", "pos", "n", "bytes"])

    return rows.mapInArrow(task, "key long, id long, rid long, pos int, n int, bytes binary")


def _merged(sent: DataFrame, window: int, chunk_bytes: int = 1 << 16) -> DataFrame:
    """(id, rid, pos, n) of windows that an earlier row holds too. Rows of one key with the same bytes
    need no comparing: all but the first are repeats."""
    dealt = sent.repartition(F.col("key")).sortWithinPartitions("key", "id", "rid", "pos")

    def task(batches):
        held: list[tuple] = []

        def work(parts):
            i = np.array([x[0] for x in parts], np.int64)
            r = np.array([x[1] for x in parts], np.int64)
            p = np.array([x[2] for x in parts], np.int64)
            order = np.lexsort((p, r, i))
            which, start = repeated([parts[k][4] for k in order], np.array([parts[k][3] for k in order]), window)
            i, r, p = i[order], r[order], p[order]
            order = np.lexsort((start, which))
            which, start = which[order], start[order]
            if not len(which):
                return
            cut = np.flatnonzero(np.concatenate(([True], (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i[which[cut]]), pa.array(r[which[cut]]), pa.array((p[which[cut]] + start[cut]).astype(np.int32)),
                 pa.array(np.diff(np.append(cut, len(which))).astype(np.int32))], ["id", "rid", "pos", "n"])

        group: dict[bytes, tuple] = {}
        last, size, same = None, 0, []
        for b in batches:
            key = b.column(0).to_numpy()
            for k, row in zip(key.tolist(), zip(*(c.to_pylist() for c in b.columns[1:]), strict=True), strict=True):
                if k != last:
                    if len(group) > 1:
                        held += group.values()
                        size += sum(map(len, group))
                        if size > chunk_bytes:
                            yield from work(held)
                            held, size = [], 0
                    group, last = {}, k
                # rows of a key come in document order; a row given twice is one occurrence
                if group.setdefault(row[4], row)[:3] != row[:3]:
                    same.append(row[:4])
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[j] for x in same], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                ["id", "rid", "pos", "n"])
            same = []
        if len(group) > 1:
            held += group.values()
        if len(held) > 1:
            yield from work(held)

    return dealt.mapInArrow(task, "id long, rid long, pos int, n int")


def _spans(keyed: DataFrame, window: int) -> DataFrame:
    """(id, rid, spans): starts and ends of the removed spans of every document that has any."""
    judged = persist(_judged(_segments(keyed, window)), "judged")
    more = _merged(_sent(keyed, judged, window), window)
    runs = judged.where(F.col("kind") == _REPEAT).select("id", "rid", "pos", F.shiftright("size", 8).alias("n")) \
        .unionByName(more)
    lists = runs.groupBy("id", "rid").agg(F.collect_list(F.struct(F.col("pos").alias("at"), "n")).alias("runs"))

    def unite(batches):
        for b in batches:
            spans = []
            flat = b.column(2).flatten()
            at, n = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy()
            off = b.column(2).offsets.to_numpy() - b.column(2).offsets[0].as_py()
            for x, y in zip(off[:-1], off[1:], strict=True):
                o = np.argsort(at[x:y], kind="stable")
                lo, hi = at[x:y][o], at[x:y][o] + n[x:y][o] - 1 + window
                top = np.maximum.accumulate(hi)
                cut = np.flatnonzero(np.concatenate(([True], lo[1:] > top[:-1])))
                spans.append(np.stack((lo[cut], top[np.append(cut[1:], len(lo)) - 1]), 1).ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, pa.list_(pa.int64()))],
                                             ["id", "rid", "spans"])

    return persist(lists.mapInArrow(unite, "id long, rid long, spans array<long>"), "spans")


def _with_spans(keyed: DataFrame, window: int) -> DataFrame:
    spans = _spans(keyed, window)
    size = spans.agg(F.sum(F.size("spans") * 8 + 160)).first()[0] or 0
    return keyed.join(_bounded(spans, size), ["id", "rid"], "left")


def _left(text: str | None, spans: list[int] | None) -> tuple[int, bytes]:
    """(bytes of the text, its bytes outside the spans)."""
    data = (text or "").encode()
    edge = [0, *(spans or []), len(data)]
    return len(data), b"".join([data[x:y] for x, y in zip(edge[::2], edge[1::2], strict=True)])


def dedup(docs: DataFrame, window: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row."""

    def task(batches):
        for b in batches:
            spans = b.column(2).to_pylist()
            got = [_left(t, s) for t, s in zip(b.column(1).to_pylist(), spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _ in got], pa.int64()),
                 pa.array([n - len(x) for n, x in got], pa.int64()),
                 pa.array([len(s or []) // 2 for s in spans], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for _, x in got], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _with_spans(_keyed(docs), window).select(F.col("doc_id").cast("long"), "text", "spans")
    return rows.mapInArrow(
        task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cleaned(docs: DataFrame, columns: list[str], window: int = 100) -> DataFrame:
    """``columns`` of every row with the repeated passages taken out of its text (a null text stays
    null; bytes of a character that is cut apart go)."""

    def task(batches):
        for b in batches:
            at = b.schema.get_field_index("text")
            texts = [None if t is None else _left(t, s)[1].decode("utf-8", "ignore") for t, s in
                     zip(b.column(at).to_pylist(), b.column(len(columns)).to_pylist(), strict=True)]
            cols = [pa.array(texts, pa.string()) if k == at else b.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays(cols, columns)

    schema = docs.select(*columns).schema
    own = [c if c == "text" else f"column_{k}" for k, c in enumerate(columns)]  # apart from the names used here
    rows = docs.select("doc_id", *[F.col(c).alias(o) for c, o in zip(columns, own, strict=True)])
    return _with_spans(_keyed(rows, tuple(own)), window).select(*own, "spans").mapInArrow(task, schema)
