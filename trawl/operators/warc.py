"""Archive export and import.

``warc_rows`` builds every header field as a column; ``write_warc`` assembles and gzips the
records inside the writer tasks of the ``warc`` data source and returns one row per committed file;
``read_warc`` reads archives back by byte ranges.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import meta as M
from trawl.functions import urls as U
from trawl.functions import warc as W
from trawl.archive import register



def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def warc_rows(pages: DataFrame, url_col: str = "url", content_col: str = "html", md_col: str | None = None,
              head_col: str | None = None, capture_col: str | None = None, fallback_time=None,
              warc_keys=M.WARC_KEYS, escape_uri: bool = False, request_col: str | None = None) -> DataFrame:
    """K3 + V1-V5: one archive record per page with all header fields as columns and the full
    header block as ``warc_header``; ``payload`` is the content as bytes. With ``request_col`` (the head of
    the HTTP request, may be null) also ``request_record``: a whole request record, for response pages."""
    content = F.col(content_col)
    payload = content if dict(pages.dtypes)[content_col] == "binary" else F.encode(content, "UTF-8")
    head = F.col(head_col) if head_col else F.lit(None).cast("string")
    md = F.col(md_col) if md_col else M.empty_md()
    rtype = W.record_type(head)
    fixed_head = F.when(rtype == "response", W.fix_http_head(head, F.octet_length(payload))).otherwise(F.lit(""))
    head_bytes = F.encode(fixed_head, "UTF-8")
    when = W.capture_time(F.col(capture_col) if capture_col else F.lit(None).cast("string"),
                          fallback_time if fallback_time is not None else F.current_timestamp())
    uri = U.uri_escape(F.col(url_col)) if escape_uri else F.regexp_replace(F.col(url_col), " ", "%20")
    ctype = F.when(rtype == "response", F.lit("application/http; msgtype=response")).otherwise(
        F.coalesce(F.nullif(F.trim(M.first(md, "Content-Type")), F.lit("")), F.lit("application/octet-stream")))
    # digests and the capture date are materialised once; the header lines refer to the columns
    base = pages.select("*", payload.alias("_payload"), rtype.alias("_type"), head_bytes.alias("_head"),
                        when.alias("_date"))
    base = U.materialize(base, "_pdig", W.sha1_base32(F.col("_payload")))
    base = U.materialize(base, "_bdig", F.when(F.col("_type") == "response", W.sha1_base32(
        F.concat(F.col("_head"), F.col("_payload")))).otherwise(F.col("_pdig")))
    payload, rtype, head_bytes, when = F.col("_payload"), F.col("_type"), F.col("_head"), F.col("_date")
    pdig, bdig = F.col("_pdig"), F.col("_bdig")
    rec_id = W.det_uuid(F.concat(F.col(url_col), F.lit("|"), when))
    lines = F.array_compact(F.array(
        F.lit(W.WARC_VERSION),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), rec_id, F.lit(">")),
        F.concat(F.lit("Content-Length: "), (F.octet_length(payload) + F.octet_length(head_bytes)).cast("string")),
        F.concat(F.lit("WARC-Date: "), when),
        F.concat(F.lit("WARC-Type: "), rtype),
        F.when(M.first(md, "_ip_").isNotNull(), F.concat(F.lit("WARC-IP-Address: "), M.first(md, "_ip_"))),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("Content-Type: "), ctype),
        F.concat(F.lit("WARC-Payload-Digest: "), pdig),
        F.concat(F.lit("WARC-Block-Digest: "), bdig),
        F.concat(F.lit("OWS.URL-ID: "), U.url_id(F.col(url_col))),
    ))
    lines = F.concat(lines, M.warc_md_lines(md, warc_keys))
    header = F.concat(F.array_join(lines, W.CRLF), F.lit(W.CRLF + W.CRLF))
    more = []
    if request_col:
        asked = F.concat(F.regexp_replace(F.col(request_col), r"(\r\n)+$", ""), F.lit(W.CRLF + W.CRLF))
        head = F.concat_ws(W.CRLF, F.lit(W.WARC_VERSION), F.lit("WARC-Type: request"),
                           F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), W.det_uuid(F.concat(rec_id, F.lit("|request"))), F.lit(">")),
                           F.concat(F.lit("WARC-Concurrent-To: <urn:uuid:"), rec_id, F.lit(">")),
                           F.concat(F.lit("WARC-Date: "), when), F.concat(F.lit("WARC-Target-URI: "), uri),
                           F.lit("Content-Type: application/http; msgtype=request"),
                           F.concat(F.lit("Content-Length: "), F.octet_length(asked).cast("string")))
        record = F.concat(head, F.lit(W.CRLF + W.CRLF), asked, F.lit(W.CRLF + W.CRLF))
        some = (rtype == "response") & F.col(request_col).isNotNull()
        more = [F.when(some, F.encode(record, "UTF-8")).alias("request_record")]
    return base.select(
        *pages.columns, rec_id.alias("record_id"), rtype.alias("type"), uri.alias("target_uri"), when.alias("date"),
        pdig.alias("payload_digest"), bdig.alias("block_digest"), header.alias("warc_header"),
        F.concat(head_bytes, payload).alias("record_block"), *more)


def block_records(blocks: DataFrame, key_cols=("page_id",)) -> DataFrame:
    """K4: each content block becomes its own record with the page's url (and metadata)."""
    return blocks.filter("is_content").select(*key_cols, "url", "block_idx",
                                               F.encode(F.col("text"), "UTF-8").alias("content"))


def write_warc(records: DataFrame, out_dir: str, crawler: str = "", max_records: int | None = None,
               info_fields: dict[str, str] | None = None, ts=None, max_bytes: int = 1 << 30,
               max_seconds: float = 600) -> DataFrame:
    """K1/K2: writes the archives through the ``warc`` data source (``trawl.archive``): a warcinfo
    member first, a member per record (a ``request_record`` before its response), a new file after
    ``max_bytes``, ``max_records`` or ``max_seconds``. Returns (path, records, bytes) of the committed files."""
    spark = records.sparkSession
    register(spark)
    stamp = ts if ts is not None else F.current_timestamp()
    job = uuid.uuid4().hex
    options = {"path": out_dir, "job": job, "max_bytes": max_bytes, "max_records": max_records or "", "max_seconds": max_seconds,
               "info": json.dumps(info_fields or {"software": "trawl", "format": "WARC File Format 1.0"})}
    more = ["request_record"] if "request_record" in records.columns else []
    records.select("warc_header", "record_block", W.archive_path(stamp, crawler, F.lit(0)).alias("path"), *more) \
        .write.format("warc").mode("append").options(**options).save()
    return spark.read.schema("path string, records long, bytes long").json(f"{out_dir.rstrip('/')}/_commits/{job}.json")


def read_warc(spark, paths, split_bytes: int = 128 << 20) -> DataFrame:
    """Archive files or folders -> (url, content, metadata) for response/resource records, plus the
    full header map. One task per ``split_bytes`` of a file."""
    register(spark)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("warc").options(paths=json.dumps(paths), split_bytes=split_bytes).load()
