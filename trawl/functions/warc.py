"""Archive record column functions.

Header fields, digests and the HTTP head repair are Column expressions over the page row;
only the final byte assembly and gzip framing of a file happen in Python (writer tasks).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WARC_VERSION = "WARC/1.0"
CRLF = "\r\n"
BASE32_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
X_HIDE = "X-Crawler-"
STATUS_LINE_RE = r"^HTTP/1\.[01] [0-9]{3}(?: .*)?$"
HTTP_VERSION_RE = r"^HTTP/1\.[01]$"
PROBLEMATIC_RE = r"(?i)^(?:Content-(?:Encoding|Length)|Transfer-Encoding)$"
HTTP_VERSION_FALLBACK = "HTTP/1.1"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hex_to_base32(hex_col) -> Column:
    """Base32 (RFC 4648) of a 40-digit hex string (160 bits = 32 symbols, no padding).

    Every 5 hex digits are 20 bits = 4 base32 symbols, so the conversion is 8 ``conv`` calls and
    32 shifts and look-ups: plain expressions inside whole-stage codegen, no lambdas."""
    h = _c(hex_col)
    out = []
    for chunk in range(8):
        v = F.conv(F.substring(h, chunk * 5 + 1, 5), 16, 10).cast("long")
        for shift in (15, 10, 5, 0):
            idx = F.shiftright(v, shift).bitwiseAND(31)
            out.append(F.substring(F.lit(BASE32_ALPHABET), (idx + 1).cast("int"), 1))
    return F.concat(*out)


def sha1_base32(payload) -> Column:
    """V1: 'sha1:' + base32 of the SHA-1 of the bytes."""
    return F.concat(F.lit("sha1:"), hex_to_base32(F.sha1(_c(payload))))


def record_type(http_head) -> Column:
    """V2: response if a stored HTTP head is not blank, else resource."""
    return F.when(F.length(F.trim(F.coalesce(_c(http_head), F.lit("")))) > 0, "response").otherwise("resource")


def fix_http_head(head, content_length) -> Column:
    """V3: status line repaired, empty and colon-less lines dropped, Content-Encoding,
    Transfer-Encoding and a wrong Content-Length hidden as X-Crawler-..., the true length added,
    ending with exactly one empty line."""
    lines = F.split(_c(head), CRLF)
    first = F.element_at(lines, 1)
    parts = F.split(first, r"\s+", 3)
    fixed_status = F.when(first.rlike(STATUS_LINE_RE), first).when(
        (F.size(parts) >= 2) & F.try_element_at(parts, F.lit(2)).rlike(r"^[0-9]{3}$"),
        F.concat(F.when(F.element_at(parts, 1).rlike(HTTP_VERSION_RE), F.element_at(parts, 1))
                 .otherwise(F.lit(HTTP_VERSION_FALLBACK)),
                 F.lit(" "), F.element_at(parts, 2), F.lit(" "),
                 F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("")))).otherwise(first)
    rest = F.slice(lines, 2, 1 << 20)
    length = _c(content_length).cast("long")

    def fix(line):
        name = F.substring_index(line, ":", 1)
        value = F.trim(F.substring(line, F.length(name) + 2, 1 << 20))
        is_len = F.lower(name) == "content-length"
        ok_len = is_len & (value.try_cast("long") == length)
        return (F.when(~line.contains(":"), F.array().cast("array<string>"))
                .when(name.rlike(PROBLEMATIC_RE) & ~ok_len,
                      F.when(is_len, F.array(F.concat(F.lit(X_HIDE), line),
                                             F.concat(F.lit("Content-Length: "), length.cast("string"))))
                      .otherwise(F.array(F.concat(F.lit(X_HIDE), line))))
                .otherwise(F.array(line)))

    kept = F.flatten(F.transform(rest, fix))
    return F.concat(F.array_join(F.concat(F.array(fixed_status), kept), CRLF), F.lit(CRLF + CRLF))


def capture_time(request_millis, fallback) -> Column:
    """V4: request time in millis when parseable, else the fallback; second precision, UTC ISO."""
    t = F.coalesce(F.timestamp_millis(_c(request_millis).try_cast("long")), _c(fallback))
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def det_uuid(seed) -> Column:
    """Deterministic UUID-shaped id from md5 of the seed (random ``uuid()`` is not re-runnable)."""
    m = F.md5(_c(seed))
    return F.concat_ws("-", F.substring(m, 1, 8), F.substring(m, 9, 4), F.substring(m, 13, 4),
                       F.substring(m, 17, 4), F.substring(m, 21, 12))


def archive_path(ts, crawler: str, rotation) -> Column:
    """K2: year=Y/month=M/day=D/[crawler=C/]HHmmss-NNNNN.warc.gz in GMT, month/day not padded."""
    t = _c(ts)
    parts = [F.lit("year="), F.date_format(t, "yyyy"), F.lit("/month="), F.date_format(t, "M"),
             F.lit("/day="), F.date_format(t, "d"), F.lit("/")]
    if crawler and crawler.strip():
        parts.append(F.lit(f"crawler={crawler}/"))
    parts += [F.date_format(t, "HHmmss"), F.lit("-"), F.lpad(_c(rotation).cast("string"), 5, "0"),
              F.lit(".warc.gz")]
    return F.concat(*parts)


def warcinfo_text(date: str, filename: str, fields: dict[str, str], record_id: str) -> str:
    """V6: warcinfo record text (fixed head, then the non-WARC-* fields)."""
    body = "".join(f"{k}: {v}{CRLF}" for k, v in fields.items() if not k.startswith("WARC-"))
    head = (f"{WARC_VERSION}{CRLF}WARC-Type: warcinfo{CRLF}WARC-Date: {date}{CRLF}WARC-Filename: {filename}{CRLF}"
            f"WARC-Record-ID: <urn:uuid:{record_id}>{CRLF}Content-Type: application/warc-fields{CRLF}"
            f"Content-Length: {len(body.encode('utf-8'))}{CRLF}{CRLF}")
    return head + body + CRLF + CRLF
