"""Archive data source: commit protocol, rotation, byte-range splits."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from conftest import page_df
from trawl import storage
from trawl.operators import warc as WO
from trawl import archive as A



def now():
    return F.lit(dt.datetime(2024, 1, 2, 3, 4, 5))


def records(spark, n=60, size=20_000, parts=3):
    rows = [(i, f"http://h{i % 7}.example.com/{i}", f"{i}:" + os.urandom(size // 2).hex()) for i in range(n)]
    return rows, WO.warc_rows(page_df(spark, rows).repartition(parts), fallback_time=now())


def names(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if not f.startswith("."))


def test_rotation_by_bytes_and_by_time(spark, tmp_path):
    rows, rec = records(spark)
    files = WO.write_warc(rec, str(tmp_path / "a"), ts=now(), max_bytes=50_000).collect()
    assert sum(f.records for f in files) == 60 and len(files) >= 12
    assert all(os.path.getsize(f.path) == f.bytes for f in files)
    late = WO.write_warc(rec, str(tmp_path / "b"), ts=now(), max_seconds=0).collect()
    assert [f.records for f in late] == [1] * 60  # each file is too old after its first record
    whole = WO.write_warc(rec, str(tmp_path / "c"), ts=now()).collect()
    assert len(whole) == 3


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    rows, rec = records(spark, parts=1)
    (file,) = WO.write_warc(rec, str(tmp_path), ts=now()).collect()
    back = WO.read_warc(spark, [file.path], split_bytes=100_000)
    parts = back.select("url", F.spark_partition_id().alias("p")).collect()
    assert len({r.p for r in parts}) >= 5
    assert sorted((r.url, bytes(r.content).decode()) for r in back.collect()) == sorted((u, h) for _, u, h in rows)
    assert WO.read_warc(spark, str(tmp_path), split_bytes=7_777).count() == 60  # smaller than a record


@pytest.mark.parametrize("split", [1, 50, 333, 10_000])
def test_ranges_own_each_member_once(tmp_path, split):
    """Every cut of a file, also inside gzip headers, and bytes that look like a header."""
    path = str(tmp_path / "x.warc.gz")
    with open(path, "wb") as out:
        for i in range(12):
            body = b"\x1f\x8b\x08\x00 not a member " * i
            out.write(gzip.compress(b"WARC/1.0\r\nWARC-Type: resource\r\nX: %d\r\nContent-Length: %d\r\n\r\n" % (i, len(body))
                                    + body + b"\r\n\r\n", compresslevel=0))
    size = os.path.getsize(path)
    got = [f["X"] for a in range(0, size, split) for f, _ in A.range_records(path, a, min(size, a + split))]
    assert got == [str(i) for i in range(12)]


def test_records_in_one_member_and_unpacked(spark, tmp_path):
    text = b"".join(b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: http://x.example/%d\r\nContent-Length: 3\r\n\r\nab%d\r\n\r\n"
                    % (i, i) for i in range(5))
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(text))
    (tmp_path / "plain.warc").write_bytes(text)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    got = WO.read_warc(spark, str(tmp_path), split_bytes=40).collect()
    assert sorted(bytes(r.content) for r in got) == sorted([b"ab%d" % i for i in range(5)] * 2)
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(text)[:-20])
    with pytest.raises(Exception, match="archive ends"):
        WO.read_warc(spark, str(tmp_path / "cut.warc.gz")).collect()


def test_lost_attempts_and_failed_jobs_leave_nothing(spark, tmp_path):
    folder = str(tmp_path / "out")
    options = {"path": folder, "job": "j1", "info": "{}"}
    writer = A.ArchiveWriter(options)
    lost = storage.open_write(f"{writer.temporary}/lost-0")  # an attempt that never committed
    lost.write(b"half a file")
    lost.close()
    done = storage.open_write(f"{writer.temporary}/done-0")
    done.write(gzip.compress(b"x"))
    done.close()
    name = "year=2024/month=1/day=2/030405-00000000.warc.gz"
    writer.commit([A.Written([(f"{writer.temporary}/done-0", name, 1, 2)]), None])
    assert names(folder) == ["_commits/j1.json", name]
    again = A.ArchiveWriter(options | {"job": "j2"})  # the same second: nothing is replaced
    more = storage.open_write(f"{again.temporary}/done-0")
    more.close()
    again.commit([A.Written([(f"{again.temporary}/done-0", name, 0, 0)])])
    assert name[:-8] + "-1.warc.gz" in names(folder)

    rows, rec = records(spark, n=9)
    bad = rec.withColumn("warc_header", F.when(F.col("page_id") != 4, F.col("warc_header")))  # a null header
    with pytest.raises((PythonException, Exception)):
        WO.write_warc(bad, folder, ts=now())
    assert len(names(folder)) == 4 and not any("_temporary" in n for n in names(folder))


def test_request_records(spark, tmp_path):
    head = "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\n"
    df = spark.createDataFrame([(1, "http://a.example.com/x", "abc", head, "GET /x HTTP/1.1\r\nHost: a.example.com\r\n\r\n"),
                                (2, "http://a.example.com/y", "abc", head, None), (3, "http://a.example.com/z", "abc", None, "GET /z HTTP/1.1")],
                               "page_id long, url string, html string, head string, asked string").coalesce(1)
    rec = WO.warc_rows(df, head_col="head", fallback_time=now(), request_col="asked")
    (file,) = WO.write_warc(rec, str(tmp_path), ts=now()).collect()
    got = [(f["WARC-Type"], f.get("WARC-Concurrent-To"), f.get("WARC-Record-ID"), b) for f, b in A.range_records(file.path, 0, file.bytes)]
    assert [g[0] for g in got] == ["warcinfo", "request", "response", "response", "resource"]
    assert got[1][1] == got[2][2] and got[1][3] == b"GET /x HTTP/1.1\r\nHost: a.example.com\r\n\r\n"
