"""Archive data source ``warc``: a writer with a commit protocol and a reader with byte-range splits
(K1, S4).

Writer. A task writes its records as gzip members to files of its own attempt below ``_temporary`` in the
target folder, a ``warcinfo`` member first in each file, and starts a new file after ``max_bytes``,
``max_records`` or ``max_seconds``. Its commit message lists the files. When all tasks are done the driver
gives the files of the committed attempts their final names, writes the list to ``_commits`` and deletes
the temporary folder; a failed job leaves nothing. So a task that is retried or run twice counts once.

Reader. Files are cut into ranges of ``split_bytes`` (small files share a range). A range owns the members
that start in it: its task looks for the next gzip header that unpacks to the begin of a record, and
reads on to the first member beyond its end. A task holds one record at a time; files whose records
are not members of their own are read by one task.
"""

from __future__ import annotations

import gzip
import io
import json
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from trawl import storage
from trawl.functions.warc import warcinfo_text

SCHEMA = ("url string, content binary, metadata map<string,array<string>>, headers map<string,string>")
_ARROW = pa.schema([("url", pa.string()), ("content", pa.binary()),
                    ("metadata", pa.map_(pa.string(), pa.list_(pa.string()))), ("headers", pa.map_(pa.string(), pa.string()))])
_SPAN = 1 << 20  # bytes read at once
_PROBE = 1 << 16  # bytes a gzip header and the first bytes of its member surely fit in
_BATCH_BYTES = 16 << 20


# ---------------------------------------------------------------- writing

@dataclass
class Written(WriterCommitMessage):
    """Files of one task: (temporary name, final name, records, bytes)."""

    files: list[tuple[str, str, int, int]]


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.job = options.get("job") or uuid.uuid4().hex
        self.info = json.loads(options.get("info") or "{}")
        self.max_bytes = int(options.get("max_bytes") or 1 << 30)
        self.max_records = int(options.get("max_records") or 1 << 62)
        self.max_seconds = float(options.get("max_seconds") or 600)
        self.temporary = f"{self.path}/_temporary/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        part, attempt, files = TaskContext.get().partitionId(), uuid.uuid4().hex, []
        out = name = None
        records = size = 0
        began = 0.0

        def close():
            out.close()
            files.append((f"{self.temporary}/{attempt}-{len(files)}", name, records, size))

        for batch in iterator:
            columns = [batch.column(c).to_pylist() for c in ("warc_header", "record_block", "path")]
            requests = batch.column("request_record").to_pylist() if "request_record" in batch.schema.names else [None] * len(batch)
            for header, block, path, request in zip(*columns, requests, strict=True):
                if out is None:
                    name = f"{path[:-len('00000.warc.gz')]}{part:05d}{len(files):03d}.warc.gz"
                    out = storage.open_write(f"{self.temporary}/{attempt}-{len(files)}")
                    info = warcinfo_text(path.split("/")[0], name.rsplit("/", 1)[-1], self.info,
                                         f"{part:08x}-0000-4000-8000-{len(files):012x}")
                    head = gzip.compress(info.encode(), mtime=0)
                    out.write(head)
                    records, size, began = 0, len(head), time.monotonic()
                for record in ([request] if request else []) + [header.encode() + block + b"\r\n\r\n"]:
                    member = gzip.compress(record, mtime=0)
                    out.write(member)
                    size += len(member)
                records += 1
                if size >= self.max_bytes or records >= self.max_records or time.monotonic() - began >= self.max_seconds:
                    close()
                    out = None
        if out is not None:
            close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        taken, rows = set(), []
        for source, name, records, size in (f for m in messages if m for f in m.files):
            final, n = f"{self.path}/{name}", 0
            while final in taken or storage.exists(final):  # an earlier job of the same second
                n += 1
                final = f"{self.path}/{name[:-len('.warc.gz')]}-{n}.warc.gz"
            storage.move(source, final)
            taken.add(final)
            rows.append({"path": final, "records": records, "bytes": size})
        with storage.open_write(f"{self.path}/_commits/{self.job}.json") as log:
            log.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        storage.remove(self.temporary)

    def abort(self, messages: list[Written | None]) -> None:
        storage.remove(self.temporary)


# ---------------------------------------------------------------- reading

class _Bytes:
    """Spans of an open file with a place to put back what was read too far."""

    def __init__(self, file, offset: int):
        self.file, self.held = file, b""
        file.seek(offset)

    def next(self) -> bytes:
        out, self.held = self.held or self.file.read(_SPAN), b""
        return out

    def tell(self) -> int:
        return self.file.tell() - len(self.held)


class _Member(io.RawIOBase):
    """The unpacked bytes of the gzip member at the place of ``source``."""

    def __init__(self, source: _Bytes):
        self.source, self.unpack = source, zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.unpack.eof:
            packed = self.unpack.unconsumed_tail or self.source.next()
            if not packed:
                raise EOFError("archive ends inside a member")
            out = self.unpack.decompress(packed, len(buffer))
            if self.unpack.eof:
                self.source.held = self.unpack.unused_data
            if out:
                buffer[:len(out)] = out
                return len(out)
        return 0


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records in a stream."""
    while line := stream.readline():
        if not line.strip():
            continue  # blank lines between records
        fields = {}
        while (line := stream.readline()).strip():
            name, colon, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            if colon:
                fields[name] = value
        size = int(fields.get("Content-Length", "0"))
        block = stream.read(size)
        if len(block) < size:
            raise EOFError("archive ends inside a record")
        yield fields, block


def first_member(file, start: int, end: int) -> int | None:
    """Start of the first member in [start, end) that begins with a record."""
    at = start
    while at < end:
        file.seek(at)
        span = file.read(_SPAN + _PROBE)
        found = span.find(b"\x1f\x8b\x08")
        while 0 <= found < min(_SPAN, end - at):
            try:
                if zlib.decompressobj(31).decompress(span[found:found + _PROBE], 64).startswith(b"WARC/"):
                    return at + found
            except zlib.error:
                pass
            found = span.find(b"\x1f\x8b\x08", found + 1)
        if len(span) < _SPAN + _PROBE:
            return None
        at += _SPAN
    return None


def range_records(uri: str, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of the members of a file that start in [start, end)."""
    with storage.open_read(uri) as file:
        head = file.read(2) if start == 0 else b"\x1f\x8b"
        if head[:2] != b"\x1f\x8b":  # not packed: the range at 0 owns the whole file
            file.seek(0)
            yield from records(io.BufferedReader(file, _SPAN) if head else io.BytesIO())
            return
        at = first_member(file, start, end) if start else 0
        if at is None:
            return
        source = _Bytes(file, at)
        while source.tell() < end:
            source.held = source.held or source.next()
            if not source.held:
                return
            if source.held[:2] not in (b"\x1f\x8b", b"\x1f"):
                raise ValueError(f"{uri} has no gzip member at {source.tell()}")
            yield from records(io.BufferedReader(_Member(source), _SPAN))


@dataclass
class Ranges(InputPartition):
    """(file, start, end) to be read by one task."""

    parts: list[tuple[str, int, int]]


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"]) if options.get("paths") else [options["path"]]
        self.split = int(options.get("split_bytes") or 128 << 20)

    def partitions(self) -> list[Ranges]:
        out, held, size = [], [], 0
        for uri, length in (f for p in self.paths for f in storage.files(p, (".warc.gz", ".warc"))):
            for start in range(0, length, self.split):
                end = min(length, start + self.split)
                if held and size + end - start > self.split:
                    out.append(Ranges(held))
                    held, size = [], 0
                held.append((uri, start, end))
                size += end - start
        return [*out, Ranges(held)] if held or not out else out

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for uri, start, end in partition.parts:
            for fields, block in range_records(uri, start, end):
                kind = fields.get("WARC-Type")
                if kind not in ("response", "resource"):
                    continue
                head, gap, body = block.partition(b"\r\n\r\n")
                payload = body if kind == "response" and gap else block
                metadata = [("warc.path", [uri]), ("warc.type", [kind]), ("warc.date", [fields.get("WARC-Date")])]
                rows.append((fields.get("WARC-Target-URI"), payload, metadata, list(fields.items())))
                size += len(payload)
                if size >= _BATCH_BYTES or len(rows) >= 1000:
                    yield self._batch(rows)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)],
                                          schema=_ARROW)


class ArchiveSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        if overwrite:
            raise ValueError("archives are only appended")
        return ArchiveWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArchiveSource)
