"""Archives written, read back and merged, against plain grouping and sorting, and against the SQL."""

import base64
import hashlib
import random
from collections import Counter

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trawl.llm import warc_history as W

SCHEMA = "page_id long, url string, html string, captured string, keeper string, sha1 long"
ROWS = [(1, "http://B.example.org/x?q=1#f", "same", "2024-01-02T00:00:00Z"), (2, "http://b.example.org/x?q=1", "same", "2024-01-01T00:00:00Z"),
        (9, "https://a.b.example.org:8080", "same", "2024-01-03T00:00:00Z"), (3, None, None, "2024-01-01T00:00:00Z"),
        (4, "", "", "2024-01-01T00:00:00Z"), (5, "not a url\r\nX: y", "é" * 300_000, "2024-01-01T00:00:00Z"),
        (6, "http://[bad", "\r\n\r\nWARC/1.1\r\n", "2024-01-01T00:00:00Z"), (9, "https://a.b.example.org:8080", "same", "2024-01-03T00:00:00Z"),
        (None, "http://z.example", "same", "2024-01-01T00:00:00Z"), (None, "http://z.example", "alone", "2024-01-01T00:00:00Z"),
        (None, "http://z.example", "alone", "2024-01-01T00:00:00Z")]
ROWS += [(100 + i, f"http://h{i % 7}.example/p{i % 3}", f"body {i % 90}" * (i % 5), f"2024-02-{1 + i % 28:02}T00:00:00Z") for i in range(400)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(4)


def brute(rows, least=0):
    out = []
    for page_id, _, html, _ in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if r[0] is not None and (r[2] or "").encode() == payload and len(payload) >= least]
        keeper = max(same, default=None)
        keeper = None if keeper == page_id else keeper
        out.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "response" if keeper is None else "revisit", keeper))
    return Counter(out)


@pytest.mark.parametrize("bound", [W.BROADCAST_PAYLOADS, 20])
def test_round_trip(spark, monkeypatch, bound, tmp_path):
    monkeypatch.setattr(W, "BROADCAST_PAYLOADS", bound)
    got = W.captures(pages(spark, ROWS), captured=F.col("captured"), folder=str(tmp_path / "a"), max_records=30, per_range=60).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(ROWS)
    got.sort(key=lambda r: (r.range, r.position))
    keys = [W._order(r.url_key, r.captured, r.page_id, r.file, r.offset) for r in got]
    assert keys == sorted(keys) and len({r.range for r in got}) > 2 and len({r.file for r in got}) > 8
    assert all([r.position for r in got if r.range == k] == list(range(sum(r.range == k for r in got))) for k in {r.range for r in got})


def test_least_bytes_and_empty(spark):
    got = W.captures(pages(spark, ROWS), min_bytes=5).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(ROWS, 5)
    assert W.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_files_outside_the_manifest_are_not_read(spark, tmp_path):
    """What an attempt that was lost leaves behind."""
    folder = str(tmp_path / "b")
    manifest = W.write(pages(spark, ROWS[:5]), folder)
    W.write(pages(spark, ROWS[:5]), folder)
    assert W.runs(manifest).count() == 5


def test_tampered_payload_is_an_error():
    good = W.record(1, "http://a.example/", b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), W.CAPTURED, None)
    assert W.parsed(good)["size"] == 7
    with pytest.raises(ValueError):
        W.parsed(good.replace(b"\r\n\r\npayload", b"\r\n\r\npaYload"))


@given(st.lists(st.lists(st.integers(0, 50)), max_size=9))
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    assert list(W.LoserTree(runs, lambda x: (x,))) == sorted(x for r in runs for x in r)


def test_url_key():
    assert W.url_key("HTTP://www.Example.org/A?b#c") == "org,example,www)/A?b"
    assert W.url_key("https://x.example:8443") == "example,x:8443)/"
    assert W.url_key(None) == ""


def test_sql():
    con = duckdb.connect()
    rows = [(r[0], r[1], r[2], None) for r in ROWS]
    random.Random(1).shuffle(rows)
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", [r[:3] for r in rows])
    assert Counter(con.execute(W.ORACLE_SQL).fetchall()) == brute(rows)
