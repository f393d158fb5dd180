"""Archive records: base32 SHA-1 digests, HTTP head repair cases (C7), file names, write/read round trip."""

import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from conftest import page_df
from trawl.functions import warc as W
from trawl.operators import warc as WO

CRLF = "\r\n"


def test_digest_matches_python(spark):
    payloads = ["", "hello", "héllo wörld" * 50]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    got = [r.d for r in df.select(W.sha1_base32(F.encode("p", "UTF-8")).alias("d")).collect()]
    exp = ["sha1:" + base64.b32encode(hashlib.sha1(p.encode()).digest()).decode() for p in payloads]
    assert got == exp


def fix(spark, head, n):
    return spark.createDataFrame([(head, n)], "h string, n long").select(W.fix_http_head(F.col("h"), F.col("n")).alias("f")).first().f


def test_head_ok_is_unchanged(spark):
    h = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html" + CRLF + "Content-Length: 5" + CRLF + CRLF
    assert fix(spark, h, 5) == h


def test_head_bad_status_line_wrong_length_missing_blank(spark):
    h = "HTTP/2 200 OK" + CRLF + "Content-Length: 7" + CRLF + "Content-Encoding: gzip" + CRLF + "junk line"
    exp = ("HTTP/1.1 200 OK" + CRLF + "X-Crawler-Content-Length: 7" + CRLF + "Content-Length: 5" + CRLF
           + "X-Crawler-Content-Encoding: gzip" + CRLF + CRLF)
    assert fix(spark, h, 5) == exp


def test_archive_path(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 7, 8, 9),)], "ts timestamp")
    p = df.select(W.archive_path(F.col("ts"), "crawlerA", F.lit(12)).alias("p")).first().p
    assert p == "year=2024/month=3/day=5/crawler=crawlerA/070809-00012.warc.gz"
    p2 = df.select(W.archive_path(F.col("ts"), " ", F.lit(3)).alias("p")).first().p
    assert p2 == "year=2024/month=3/day=5/070809-00003.warc.gz"


def test_roundtrip(spark, tmp_path):
    import datetime as dt
    rows = [(i, f"http://h{i % 3}.example.com/p/{i}", f"<html><body>page {i} é</body></html>") for i in range(25)]
    pages = page_df(spark, rows).repartition(3)
    rec = WO.warc_rows(pages, fallback_time=F.lit(dt.datetime(2024, 1, 1)))
    files = WO.write_warc(rec, str(tmp_path), crawler="t", max_records=4, ts=F.lit(dt.datetime(2024, 1, 2, 3, 4, 5))).collect()
    assert sum(f.records for f in files) == 25 and all(f.records <= 4 for f in files)
    first = files[0].path
    assert "year=2024/month=1/day=2/crawler=t/030405-" in first
    with open(first, "rb") as fh:
        text = gzip.decompress(fh.read()).decode("utf-8")
    assert text.startswith("WARC/1.0" + CRLF + "WARC-Type: warcinfo")
    back = WO.read_warc(spark, [f.path for f in files])
    got = {r.url: bytes(r.content).decode() for r in back.collect()}
    assert got == {u: h for _i, u, h in rows}
    digests = {r.headers["WARC-Target-URI"]: r.headers["WARC-Payload-Digest"] for r in back.collect()}
    u, h = rows[7][1], rows[7][2]
    assert digests[u] == "sha1:" + base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()


def test_response_record_with_head(spark):
    import datetime as dt
    head = "HTTP/1.1 200 OK" + CRLF + "Content-Length: 999" + CRLF + CRLF
    df = spark.createDataFrame([(1, "http://a.example.com/x y", "abc", head)], "page_id long, url string, html string, head string")
    r = WO.warc_rows(df, head_col="head", fallback_time=F.lit(dt.datetime(2024, 1, 1))).first()
    assert r.type == "response" and "WARC-Target-URI: http://a.example.com/x%20y" in r.warc_header
    block = bytes(r.record_block).decode()
    assert "X-Crawler-Content-Length: 999" in block and "Content-Length: 3" in block
    assert r.block_digest != r.payload_digest
