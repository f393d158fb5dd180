"""Metadata map column functions (M1-M5) over ``MAP<STRING, ARRAY<STRING>>``.

Duplicate keys in ``map_concat`` resolve last-wins (``spark.sql.mapKeyDedupPolicy=LAST_WIN``,
set by ``trawl.session.configure``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MD_TYPE = "map<string,array<string>>"

# Metadata keys kept per purpose, as configured for the regular crawl.
PERSIST_KEYS = ["_redirTo", "fetch.statusCode", "error.cause", "error.source", "last-modified", "signature",
                "fetchInterval", "isSitemap", "isFeed", "discoveryDate", "lastProcessedDate",
                "isDiscoveredOnSitemap", "is*", "parse.*", "canonical", "robots", "urlId", "warc-filename",
                "owseu.onDemandCrawl"]
TRANSFER_KEYS = ["depth", "url.path", "maxLinkDepth", "parentRelevance", "maxPageLinkDepth"]
WARC_KEYS = ["curlieLabel", "robots", "canonical", "parse.meta.author", "parse.meta.copyright", "parse.license"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def empty_md() -> Column:
    return F.create_map().cast(MD_TYPE)


def first(md, key: str) -> Column:
    return F.try_element_at(F.element_at(_c(md), F.lit(key)), F.lit(1))


def merge_md(base, other, prefix: str = "") -> Column:
    """M1: ``base`` plus ``other`` with keys under ``prefix``; values of ``other`` win."""
    o = _c(other) if not prefix else F.transform_keys(_c(other), lambda k, v: F.concat(F.lit(prefix), k))
    return F.map_concat(F.coalesce(_c(base), empty_md()), F.coalesce(o, empty_md()))


def set_value(md, key: str, value) -> Column:
    """M2: replace the values of ``key`` with one value."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.map_concat(F.coalesce(_c(md), empty_md()), F.create_map(F.lit(key), F.array(v.cast("string"))))


def add_value(md, key: str, value) -> Column:
    """M2: append one value to ``key``."""
    v = value if isinstance(value, Column) else F.lit(value)
    m = F.coalesce(_c(md), empty_md())
    cur = F.coalesce(F.element_at(m, F.lit(key)), F.array().cast("array<string>"))
    return F.map_concat(m, F.create_map(F.lit(key), F.array_append(cur, v.cast("string"))))


def remove_key(md, key: str) -> Column:
    """M2: drop ``key``."""
    return F.map_filter(_c(md), lambda k, v: k != F.lit(key))


def wildcard_regex(patterns) -> str:
    """'is*' style patterns to one anchored regex."""
    parts = [re.escape(p).replace(r"\*", ".*") for p in patterns]
    return "^(" + "|".join(parts) + ")$"


def select_md(md, patterns) -> Column:
    """M3: keep the keys matching any of the (wildcard) patterns."""
    rx = wildcard_regex(patterns)
    return F.map_filter(_c(md), lambda k, v: k.rlike(rx))


def inherit_md(md, parent_url, keys=TRANSFER_KEYS) -> Column:
    """M4: metadata of an out-link: the parent's transfer keys, the parent URL appended to
    ``url.path`` and ``depth`` + 1."""
    m = select_md(F.coalesce(_c(md), empty_md()), keys)
    path = F.array_append(F.coalesce(F.element_at(m, F.lit("url.path")), F.array().cast("array<string>")),
                          _c(parent_url))
    depth = (F.coalesce(first(m, "depth").try_cast("int"), F.lit(0)) + 1).cast("string")
    return F.map_concat(m, F.create_map(F.lit("url.path"), path, F.lit("depth"), F.array(depth)))


def warc_md_lines(md, keys=WARC_KEYS) -> Column:
    """M5: 'OWS.<KEY>: <V1, V2>' header lines (upper-cased) for the configured keys present."""
    lines = [F.when(F.element_at(_c(md), F.lit(k)).isNotNull(), F.concat(
        F.lit("OWS." + k.upper() + ": "), F.upper(F.array_join(F.element_at(_c(md), F.lit(k)), ", "))))
        for k in keys]
    return F.array_compact(F.array(*lines))


def md_from_json(js) -> Column:
    """Parse a JSON object into the metadata map; scalars become one-element lists."""
    parsed = F.from_json(_c(js), "map<string,string>")
    return F.transform_values(parsed, lambda k, v: F.array(v))


def md_to_json(md) -> Column:
    return F.to_json(_c(md))
