"""WARC archives with revisit records and their globally ordered capture index (operator 12).

Writing: every task writes its rows as gzip members of archives in the shared folder (a new file
after ``max_bytes`` or ``max_records``) and returns one manifest row per file. File names are unique
per attempt and only files of the written manifest are read, so a task that runs twice leaves an
unread file, never a second record.

Of rows with equal payloads (SHA-1 and length) of at least ``min_bytes`` bytes, the one with the largest
page_id is written whole (``response``), the others as ``revisit`` records that hold the headers of the
payload and name the page they repeat.

Reading: a task streams an archive member by member, hashes the payload it finds again and sorts the
archive's captures by URL key, time and page_id: a locally sorted run, in memory as long as an
archive's records. Merging: splitters cut the key space into ranges of about ``per_range`` captures;
a range's slices of all runs are merged by a tournament tree of losers (one comparison per level for
each capture). Keys end with file and offset, so captures of one URL, however many, split too.

Defined results: a null html is an empty payload; among equal payloads null ids come below all others
and if all are null, all are responses; rows that share the largest id are all responses; a null URL has
the empty key; equal rows are records of their own; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.store import persist
from trawl.session import ensure_checkpoint_dir
from trawl.storage import open_read, open_write

#: Repeated payloads that may be broadcast (about 60 bytes each).
BROADCAST_PAYLOADS = 500_000
#: Time of a capture where the pages name none.
CAPTURED = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RUN = ("file string, seq long, url_key string, captured string, page_id long, url string, record_type string, "
        "payload_digest string, payload_bytes long, refers_to long, offset long, length long")
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(),
          pa.int64(), pa.int64(), pa.int64(), pa.int64()]
_NAMES = [c.split()[0] for c in _RUN.split(", ")]


def typed(pages: DataFrame, min_bytes: int, captured: Column) -> DataFrame:
    """page_id, url, html, sha1, captured, keeper (page_id of the response that a revisit repeats)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha1(html).alias("sha1"), captured.cast("string").alias("captured"),
                        F.octet_length(html).alias("size"))
    repeated = persist(rows.where(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null"), "payloads")
    few = repeated.count() <= BROADCAST_PAYLOADS
    if not few:  # a payload of many rows: at most BROADCAST_PAYLOADS hold more than that part of all rows
        least = -(-pages.count() // BROADCAST_PAYLOADS)
        often, seldom = repeated.where(F.col("n") > least), repeated.where(F.col("n") <= least)
        rows = rows.join(F.broadcast(often.drop("n")), ["sha1", "size"], "left")
        rest = rows.where("keeper is null").drop("keeper").join(seldom.drop("n"), ["sha1", "size"], "left")
        rows = rows.where("keeper is not null").unionByName(rest)
    else:
        rows = rows.join(F.broadcast(repeated.drop("n")), ["sha1", "size"], "left")
    return rows.withColumn("keeper", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))) \
        .select("page_id", "url", "html", "sha1", "captured", "keeper")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def record(page_id, url, payload: bytes, digest: str, captured: str, keeper) -> bytes:
    """One WARC record. ``keeper`` None: a response with the payload, else a revisit without it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if keeper is None else http
    head = [("WARC-Type", "response" if keeper is None else "revisit"), ("WARC-Record-ID", _record_id(page_id, digest)),
            ("WARC-Date", captured), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    if url is not None:  # control characters cannot stand in a header line
        head.append(("WARC-Target-URI", "".join(quote(c) if c < " " else c for c in url)))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if keeper is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(keeper, digest)), ("X-Refers-To-Page-ID", str(keeper))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, min_bytes: int = 0, captured: Column | None = None,
          max_bytes: int = 64 << 20, max_records: int = 50_000) -> DataFrame:
    """Writes the archives; returns the written manifest: file, records, bytes."""

    def task(batches):
        from pyspark import TaskContext

        name = f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        out, count, size, n_files = None, 0, 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pylist([{"file": f"{name}-{n_files:05d}.warc.gz", "records": count, "bytes": size}])

        for b in batches:
            for page_id, url, html, sha1, when, keeper in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if out is None:
                    out = open_write(f"{name}-{n_files:05d}.warc.gz")
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = pack.compress(record(page_id, url, html.encode(), digest, when, keeper)) + pack.flush()
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= max_bytes or count >= max_records:
                    yield closed()
                    out, count, size, n_files = None, 0, 0, n_files + 1
        if out is not None:
            yield closed()

    rows = typed(pages, min_bytes, F.lit(CAPTURED) if captured is None else captured)
    return persist(rows.mapInArrow(task, "file string, records long, bytes long"), "manifest")


def members(file, span: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member of an open archive, read in spans."""
    offset, rest, at_end = 0, b"", False
    while True:
        unpack, parts, used = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            if not rest and not at_end:
                rest = file.read(span)
                at_end = not rest
            if not rest:
                if used:
                    raise ValueError("archive ends inside a member")
                return
            parts.append(unpack.decompress(rest))
            used += len(rest) - len(unpack.unused_data)
            rest = unpack.unused_data
        yield offset, used, b"".join(parts)
        offset += used


def parsed(content: bytes) -> dict:
    """Headers of a record, with the payload's digest and length: found in a response's payload (an
    error if its digest is not the header's), taken from the headers of a revisit."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != told:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is not the one written")
    else:
        length = next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        size, digest = int(length.split(b":")[1]), told
    return fields | {"digest": digest, "size": size}


def url_key(url: str | None) -> str:
    """Sort-friendly URL: host labels reversed, lower case, then path and query; empty for none."""
    if not url:
        return ""
    rest = url.split("#", 1)[0]
    try:
        parts = urlsplit(rest)
        if not parts.netloc:
            return rest.lower()
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return rest.lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")"
    return key + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def _order(key, captured, page_id, file, offset):
    return key, captured, page_id is not None, page_id or 0, file, offset


def runs(manifest: DataFrame, chunk: int = 4096) -> DataFrame:
    """The captures of each archive of the manifest, read back and sorted."""

    def task(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                found = []
                with open_read(name) as file:
                    for offset, length, content in members(file):
                        r = parsed(content)
                        ids = [int(r[k]) if k in r else None for k in ("X-Page-ID", "X-Refers-To-Page-ID")]
                        url = r.get("WARC-Target-URI")
                        found.append((url_key(url), r["WARC-Date"], ids[0], url, r["WARC-Type"], r["digest"], r["size"],
                                      ids[1], offset, length))
                found.sort(key=lambda x: _order(x[0], x[1], x[2], name, x[8]))
                rows = [(name, i, *x) for i, x in enumerate(found)]
                for i in range(0, len(rows), chunk):
                    yield _batch(rows[i:i + chunk])

    files = manifest.select("file")
    return files.repartition(max(1, manifest.count())).mapInArrow(task, _RUN)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], _NAMES)


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of their match, so that the next head of the
    winner's run plays only the losers on its way up. ``key`` gives a row's order."""

    def __init__(self, runs: list[Iterable], key):
        self.runs, self.key = [iter(r) for r in runs], key
        k = len(self.runs)
        self.rows: list = [None] * k
        self.keys: list[tuple] = [(1,)] * k + [(0,)]  # the last one wins every match of the building
        self.tree = [k] * max(k, 1)
        for i in reversed(range(k)):
            self._draw(i)
            self._play(i)

    def _draw(self, run: int) -> None:
        row = next(self.runs[run], None)
        self.rows[run], self.keys[run] = row, (2,) if row is None else (1, self.key(row))

    def _play(self, run: int) -> None:
        tree, keys = self.tree, self.keys
        at = (run + len(self.runs)) >> 1
        while at:
            if keys[tree[at]] < keys[run]:
                run, tree[at] = tree[at], run
            at >>= 1
        tree[0] = run

    def __iter__(self):
        if not self.runs:
            return
        while self.rows[self.tree[0]] is not None:
            winner = self.tree[0]
            yield self.rows[winner]
            self._draw(winner)
            self._play(winner)


def _merged(chunk: int = 4096):
    def task(batches):
        from pyspark import TaskContext

        slices: list[list[tuple]] = []
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if not slices or slices[-1][-1][0] != row[0]:
                    slices.append([])
                slices[-1].append(row)
        part, at, out = TaskContext.get().partitionId(), 0, []
        for row in LoserTree(slices, lambda r: _order(r[2], r[3], r[4], r[0], r[10])):
            out.append(row)
            if len(out) == chunk:
                yield placed(out, part, at)
                at, out = at + chunk, []
        if out:
            yield placed(out, part, at)

    def placed(rows, part, at):
        b = _batch(rows)
        return b.append_column("range", pa.array([part] * len(rows), pa.int32())).append_column(
            "position", pa.array(range(at, at + len(rows)), pa.int64()))
    return task


def histories(sorted_runs: DataFrame, per_range: int = 100_000) -> DataFrame:
    """All captures with their place in the global order: ``range``, then ``position`` in it."""
    n = max(1, -(-sorted_runs.count() // per_range))
    dealt = sorted_runs.repartitionByRange(n, "url_key", "captured", "page_id", "file", "offset")
    return dealt.sortWithinPartitions("file", "seq").mapInArrow(_merged(), _RUN + ", range int, position long")


def captures(pages: DataFrame, min_bytes: int = 0, captured: Column | None = None, folder: str | None = None,
             max_bytes: int = 64 << 20, max_records: int = 50_000, per_range: int = 100_000) -> DataFrame:
    """Writes the archives below ``folder`` (a new one in the shared checkpoint folder by default), reads
    them back and merges their runs into the ordered captures."""
    root = folder or f"{ensure_checkpoint_dir(pages.sparkSession).rstrip('/')}/trawl-archives-{uuid.uuid4().hex}"
    manifest = write(pages, root, min_bytes, captured, max_bytes, max_records)
    return histories(persist(runs(manifest), "runs"), per_range)


def digests(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back."""
    return captures(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = "array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((((strpos('0123456789abcdef', substr(h, 1 + 5 * i // 4, 1)) - 1) * 16 + greatest(strpos('0123456789abcdef', substr(h, 2 + 5 * i // 4, 1)) - 1, 0)) >> (3 - (5 * i) % 4)) & 31), 1) for i in range(32)], '')"

#: ``digests`` in DuckDB.
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM p)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM k
"""
