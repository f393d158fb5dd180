"""Archive queries over ``pages``: record headers (V1-V5, M5), digests (V1), HTTP head repair (V3),
archive paths (K2), block records (K4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import warc as W
from trawl.operators import blocks as B
from trawl.operators import warc as WO
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.plans.queries_blocks import blocks_sql
from trawl.session import configure, load_table

CRLF_SQL = "(chr(13) || chr(10))"


def _pages(spark, sf_dir):
    configure(spark)
    p = load_table(spark, sf_dir, "pages")
    return p.withColumn("capture_ts", F.timestamp_add("SECOND", F.col("page_id") * 3671,
                                                      F.lit("2024-01-01 00:00:00").cast("timestamp")))


def _sql_base32(hex_expr: str) -> str:
    bits = (f"list_reduce(list_transform(string_split({hex_expr}, ''), "
            f"lambda d: lpad(bin(('0x' || d)::INTEGER), 4, '0')), lambda a, b: a || b)")
    val = " + ".join(f"substr(bits, i * 5 + {j + 1}, 1)::INTEGER * {16 >> j}" for j in range(5))
    return (f"(SELECT array_to_string(list_transform(range(0, 32), lambda i: substr({Q.lit(W.BASE32_ALPHABET)}, "
            f"({val}) + 1, 1)), '') FROM (SELECT {bits} AS bits))")


def _sql_uuid(seed: str) -> str:
    m = f"md5({seed})"
    return (f"(substr({m}, 1, 8) || '-' || substr({m}, 9, 4) || '-' || substr({m}, 13, 4) || '-' || "
            f"substr({m}, 17, 4) || '-' || substr({m}, 21, 12))")


SQL_P = "p AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id * 3671) AS capture_ts FROM pages)"
SQL_HDR = f"""{SQL_P},
h AS (SELECT page_id, url, strftime(capture_ts, '%Y-%m-%dT%H:%M:%SZ') AS d, 'sha1:' || {_sql_base32('sha1(html)')} AS dig
      FROM p)"""


@register("warc_headers", f"""
WITH {SQL_HDR}
SELECT page_id, 'WARC/1.0' || {CRLF_SQL} || 'WARC-Record-ID: <urn:uuid:' || {_sql_uuid("url || '|' || d")} || '>' || {CRLF_SQL}
       || 'Content-Length: ' || octet_length(encode(html)) || {CRLF_SQL} || 'WARC-Date: ' || d || {CRLF_SQL}
       || 'WARC-Type: resource' || {CRLF_SQL} || 'WARC-Target-URI: ' || replace(url, ' ', '%20') || {CRLF_SQL}
       || 'Content-Type: application/octet-stream' || {CRLF_SQL} || 'WARC-Payload-Digest: ' || dig || {CRLF_SQL}
       || 'WARC-Block-Digest: ' || dig || {CRLF_SQL}
       || 'OWS.URL-ID: ' || CASE WHEN {Q.is_valid(Q.dot_segments(Q.strip_fragment('url')))}
                                 THEN sha256({Q.dot_segments(Q.strip_fragment('url'))}) ELSE 'ERROR' END
       || {CRLF_SQL} || {CRLF_SQL} AS warc_header
FROM h JOIN pages USING (page_id, url)
""")
def q_warc_headers(spark, sf_dir):
    r = WO.warc_rows(_pages(spark, sf_dir), fallback_time=F.col("capture_ts"))
    return r.select("page_id", "warc_header")


@register("warc_digest", f"""
WITH {SQL_HDR}
SELECT page_id, dig AS payload_digest, dig AS block_digest, 'resource' AS type FROM h
""")
def q_warc_digest(spark, sf_dir):
    r = WO.warc_rows(_pages(spark, sf_dir), fallback_time=F.col("capture_ts"))
    return r.select("page_id", "payload_digest", "block_digest", "type")


def _head_spark():
    crlf = W.CRLF
    url = F.col("url")
    status = (F.when(url.contains("#"), F.lit("HTTP/1.1 200")).when(url.contains("?"), F.lit("HTTP/2 200 OK"))
              .otherwise(F.lit("HTTP/1.1 200 OK")))
    n = F.octet_length("html")
    length = F.when(url.endswith(".html"), n + 7).otherwise(n)
    enc = F.when(url.contains("?"), F.lit("Content-Encoding: gzip" + crlf)).otherwise(F.lit(""))
    return F.concat(status, F.lit(crlf + "Content-Type: text/html" + crlf + "Content-Length: "), length.cast("string"),
                    F.lit(crlf), enc, F.lit("broken line" + crlf + crlf + crlf))


def _head_sql():
    return (f"(CASE WHEN contains(url, '#') THEN 'HTTP/1.1 200' WHEN contains(url, '?') THEN 'HTTP/2 200 OK' "
            f"ELSE 'HTTP/1.1 200 OK' END || {CRLF_SQL} || 'Content-Type: text/html' || {CRLF_SQL} || 'Content-Length: ' "
            f"|| CASE WHEN ends_with(url, '.html') THEN octet_length(encode(html)) + 7 ELSE octet_length(encode(html)) END "
            f"|| {CRLF_SQL} || CASE WHEN contains(url, '?') THEN 'Content-Encoding: gzip' || {CRLF_SQL} ELSE '' END "
            f"|| 'broken line' || {CRLF_SQL} || {CRLF_SQL} || {CRLF_SQL})")


@register("http_head_fix", f"""
WITH hd AS (SELECT page_id, octet_length(encode(html)) AS n, string_split({_head_sql()}, {CRLF_SQL}) AS lines FROM pages),
st AS (SELECT page_id, n, lines, lines[1] AS first,
              regexp_extract(lines[1], '^(\\S+)', 1) AS p1, regexp_extract(lines[1], '^\\S+\\s+(\\S+)', 1) AS p2,
              regexp_extract(lines[1], '^\\S+\\s+\\S+\\s+(.*)$', 1) AS p3 FROM hd),
fx AS (SELECT page_id, n, lines,
              CASE WHEN regexp_matches(first, {Q.lit(W.STATUS_LINE_RE)}) THEN first
                   WHEN regexp_matches(p2, '^[0-9]{{3}}$')
                   THEN CASE WHEN regexp_matches(p1, {Q.lit(W.HTTP_VERSION_RE)}) THEN p1 ELSE 'HTTP/1.1' END || ' ' || p2 || ' ' || p3
                   ELSE first END AS status_line FROM st),
ln AS (SELECT page_id, n, status_line, unnest(lines[2:]) AS line, unnest(generate_series(2, len(lines))) AS pos FROM fx),
ln2 AS (SELECT *, split_part(line, ':', 1) AS name, trim(substr(line, length(split_part(line, ':', 1)) + 2)) AS value FROM ln),
out AS (SELECT page_id, pos, 0 AS sub, CASE WHEN regexp_matches(name, {Q.lit(W.PROBLEMATIC_RE)})
                   AND NOT (lower(name) = 'content-length' AND TRY_CAST(value AS BIGINT) = n)
              THEN 'X-Crawler-' || line ELSE line END AS l FROM ln2 WHERE contains(line, ':')
        UNION ALL
        SELECT page_id, pos, 1 AS sub, 'Content-Length: ' || n FROM ln2
        WHERE contains(line, ':') AND lower(name) = 'content-length' AND TRY_CAST(value AS BIGINT) IS DISTINCT FROM n),
agg AS (SELECT page_id, string_agg(l, {CRLF_SQL} ORDER BY pos, sub) AS rest FROM out GROUP BY page_id)
SELECT fx.page_id, fx.status_line || coalesce({CRLF_SQL} || agg.rest, '') || {CRLF_SQL} || {CRLF_SQL} AS fixed_head
FROM fx LEFT JOIN agg USING (page_id)
""")
def q_http_head_fix(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", W.fix_http_head(_head_spark(), F.octet_length("html")).alias("fixed_head"))


@register("archive_path", f"""
WITH {SQL_P}
SELECT page_id, 'year=' || strftime(capture_ts, '%Y') || '/month=' || strftime(capture_ts, '%-m') || '/day='
       || strftime(capture_ts, '%-d') || '/crawler=trawl/' || strftime(capture_ts, '%H%M%S') || '-'
       || lpad(CAST(page_id // 100 AS VARCHAR), 5, '0') || '.warc.gz' AS path
FROM p
""")
def q_archive_path(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", W.archive_path(F.col("capture_ts"), "trawl",
                                              F.floor(F.col("page_id") / 100).cast("long")).alias("path"))


@register("block_records", f"""
WITH {blocks_sql(B.MIN_WORDS)}
SELECT page_id, url, block_idx, octet_length(encode(text)) AS n_bytes, md5(text) AS content_md5 FROM blk WHERE is_content
""")
def q_block_records(spark, sf_dir):
    configure(spark)
    blocks = B.segment_pages(load_table(spark, sf_dir, "pages"))
    r = WO.block_records(blocks)
    return r.select("page_id", "url", "block_idx", F.octet_length("content").cast("long").alias("n_bytes"),
                    F.md5("content").alias("content_md5"))
