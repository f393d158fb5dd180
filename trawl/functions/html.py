"""HTML column functions: tag patterns, robots directives (P6, P7), redirects (P9), visible text.

Directives and redirects read the page's tag table (``tags.table``); visible text uses JVM regular
expressions over the ``html`` column. The patterns named here are written in the common subset of Java and
RE2 syntax, as the SQL oracles use them.
"""

from __future__ import annotations

import codecs

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions import tags as T

# <a ...>anchor</a>: group 1 = attributes, group 2 = inner html
A_TAG_RE = r"(?is)<a\s([^>]*)>(.*?)</a>"
# plain href list used by the fast link extractor (P2): group 1 = href
A_HREF_RE = r"""(?is)<a\s[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
META_TAG_RE = r"(?is)<meta\s[^>]*>"

# Robots directive names, in declaration order; 'none' expands to the three after it.
ROBOTS_DIRECTIVES = ["noai", "noarchive", "nocache", "nofollow", "noimageai", "noimageindex",
                     "noindex", "noml", "nosnippet", "notranslate", "none"]
NONE_EXPANSION = ["noindex", "nofollow", "nocache"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def directives_from_values(values) -> Column:
    """Normalise an array of raw directive strings: trim, lower, keep known names, expand 'none'."""
    words = F.transform(_c(values), lambda v: F.lower(F.trim(v)))
    known = F.filter(words, lambda v: v.isin(*ROBOTS_DIRECTIVES))
    return F.flatten(F.transform(known, lambda v: F.when(
        v == "none", F.array(*[F.lit(x) for x in NONE_EXPANSION])).otherwise(F.array(v))))


def meta_robots_content(page_tags) -> Column:
    """content of the first meta tag with one whose name contains robots (any case), NULL if none."""
    attrs = T.first_tag(page_tags, "meta", lambda a: T.get(a, "name").rlike("(?i)robots") & T.get(a, "content").isNotNull())
    return T.get(attrs, "content")


def robots_directives(header_values=None, meta_content=None) -> Column:
    """Directives from the X-Robots-Tag header values and the robots meta content.

    A single header value is split on commas; several values are taken as they are.
    """
    parts = []
    if header_values is not None:
        hv = F.coalesce(_c(header_values), F.array().cast("array<string>"))
        hv = F.when(F.size(hv) == 1, F.split(hv[0], r"\s*,\s*")).otherwise(hv)
        parts.append(directives_from_values(hv))
    if meta_content is not None:
        mc = F.coalesce(F.split(_c(meta_content), r"\s*,\s*"), F.array().cast("array<string>"))
        parts.append(directives_from_values(mc))
    if not parts:
        return F.array().cast("array<string>")
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def is_noindex(directives) -> Column:
    return F.array_contains(_c(directives), "noindex")


def is_nofollow(directives) -> Column:
    return F.array_contains(_c(directives), "nofollow")


def is_nocache(directives) -> Column:
    return F.array_contains(_c(directives), "nocache")


def meta_refresh_target(page_tags) -> Column:
    """URL of <meta http-equiv=refresh content="n;URL=...">, NULL if none."""
    attrs = T.first_tag(page_tags, "meta", lambda a: F.lower(T.get(a, "http-equiv")) == "refresh")
    target = F.regexp_extract(T.get(attrs, "content"), r"(?i)^\s*\d*\s*;\s*url\s*=\s*['\"]?([^'\"]+)", 1)
    return F.when(F.trim(target) != "", F.trim(target))


def canonical_href(page_tags) -> Column:
    """P10: non-blank href of the first <link rel=canonical>, NULL if none."""
    attrs = T.first_tag(page_tags, "link", lambda a: F.lower(F.trim(T.get(a, "rel"))) == "canonical")
    href = F.trim(T.get(attrs, "href"))
    return F.when(href != "", href)


def decode_entities(text) -> Column:
    """Decode the common named and numeric-free HTML entities."""
    t = _c(text)
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return t


def strip_tags(fragment) -> Column:
    """Text of an html fragment: tags removed, entities decoded, whitespace squeezed."""
    t = F.regexp_replace(_c(fragment), r"<[^>]*>", " ")
    t = decode_entities(t)
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def visible_text(html) -> Column:
    """Page text without script, style, comments and tags."""
    t = F.regexp_replace(_c(html), r"(?is)<script\b.*?</script>", " ")
    t = F.regexp_replace(t, r"(?is)<style\b.*?</style>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    return strip_tags(t)


def declared_charset(content_type=None, html_head=None) -> Column:
    """Charset from the Content-Type header, else from <meta charset> / http-equiv in the
    document head; upper-cased, NULL when none is declared."""
    parts = []
    if content_type is not None:
        parts.append(F.regexp_extract(_c(content_type), r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", 1))
    if html_head is not None:
        parts.append(F.regexp_extract(_c(html_head), r"(?i)<meta[^>]+charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", 1))
    return F.upper(F.coalesce(*[F.nullif(p, F.lit("")) for p in parts])) if parts else F.lit(None).cast("string")


def decode_content(content, charset) -> Column:
    """Bytes to text by the declared charset, UTF-8 where it is null or unknown; malformed bytes become
    replacement characters. Null content stays null."""

    @F.arrow_udf("string")
    def decoded(contents: pa.Array, charsets: pa.Array) -> pa.Array:
        out = []
        for raw, name in zip(contents.to_pylist(), charsets.to_pylist(), strict=True):
            try:
                codec = codecs.lookup(name or "UTF-8")
                text = raw and raw.decode(codec.name if codec._is_text_encoding else "UTF-8", "replace")
            except (LookupError, ValueError):
                text = raw.decode("UTF-8", "replace") if raw else raw
            out.append("" if text == b"" else text)
        return pa.array(out, pa.string())

    return decoded(_c(content), _c(charset))
