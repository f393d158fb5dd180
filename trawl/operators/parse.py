"""Page parsing operators over a ``pages(page_id, url, html[, metadata])`` DataFrame.

P2/P3 link extraction, P4/P5 nofollow, P6-P8 robots, P9/P10 redirects, P11 out-link cap,
P12 status rows, P13 depth defaults, P14-P18 parse filters, P19 text, P20 fan-out, R2 MIME route.

All of it is row-local: links of a page are extracted, resolved and de-duplicated inside the
page's own row with array functions, so no shuffle is needed until links are grouped by target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.functions import tags as T
from trawl.functions import urls as U


def page_directives(pages: DataFrame, header_col: str | None = None, skip_headers: bool = False,
                    skip_meta: bool = False) -> Column:
    """P6 + P8: robots directives of a page from the header values and/or the meta tag."""
    hdr = None
    if header_col is not None and not skip_headers:
        hdr = F.col(header_col)
    elif "metadata" in pages.columns and not skip_headers:
        hdr = F.element_at(F.col("metadata"), F.lit("X-Robots-Tag"))
    meta = None if skip_meta else H.meta_robots_content(_page_tags(pages))
    return H.robots_directives(hdr, meta)


def _page_tags(pages: DataFrame) -> Column:
    """The tag table of a page: its column ``tags`` where it was made before, else the scan."""
    return F.col("tags") if "tags" in pages.columns else T.table("html", "meta")


def with_tags(pages: DataFrame) -> DataFrame:
    """``pages`` with the tag table of each page (``tags``), made once for all that reads it."""
    return U.materialize(pages, "tags", T.table("html"))


def extract_links(pages: DataFrame, max_per_page: int = -1, anchors: bool = False,
                  strict_nofollow: bool = True, url_col: str = "url", key_cols=("page_id",),
                  skip_headers: bool = False, skip_meta: bool = False) -> DataFrame:
    """One row per distinct resolved out-link of a page, in document order.

    Output: key_cols, ``src_url``, ``link_pos`` (1-based position of the first occurrence),
    ``target``, and with ``anchors=True`` also ``anchor`` (first non-blank anchor) and
    ``anchors`` (all non-blank anchors in order).
    """
    header_col = ["metadata"] if "metadata" in pages.columns and "metadata" not in key_cols else []
    scanned = F.col("tags") if "tags" in pages.columns else T.table("html", "a", "meta")
    # made once: a filter on it must not be pushed below the scan with a second scan
    base = U.materialize(pages.select("*", F.col(url_col).alias("src_url")), "_found", scanned) \
        .select(*key_cols, "src_url", *header_col, "_found")
    header = F.element_at("metadata", F.lit("X-Robots-Tag")) if "metadata" in pages.columns and not skip_headers else None
    directives = H.robots_directives(header, None if skip_meta else H.meta_robots_content("_found"))
    base = base.withColumn("_page_nofollow", H.is_nofollow(directives))
    if strict_nofollow:  # P5 strict: no links at all
        base = base.filter(~F.col("_page_nofollow"))
    found = F.filter("_found", lambda t: (t["name"] == "a") & T.get(t["attrs"], "href").isNotNull())
    # the resolver below refers to the href many times, so it must be a field
    tags = F.transform(found, lambda t: F.struct(
        T.get(t["attrs"], "href").alias("href"),
        F.coalesce(F.lower(F.trim(T.get(t["attrs"], "rel"))) == "nofollow", F.lit(False)).alias("nofollow"),
        *([t["text"].alias("anchor")] if anchors else [])))
    if strict_nofollow:
        tags = F.filter(tags, lambda t: ~t["nofollow"])
    base = U.materialize(base, "_tags", tags)
    links = F.filter(F.transform("_tags", lambda t: F.struct(
        U.resolve(F.col("src_url"), t["href"]).alias("target"), t["nofollow"].alias("nofollow"),
        *([t["anchor"].alias("anchor")] if anchors else []))), lambda s: s["target"].isNotNull())
    if not anchors:
        # distinct targets inside the row: array_distinct keeps first occurrences in order,
        # so the whole operator is a projection + explode (no shuffle).
        targets = F.array_distinct(F.transform(links, lambda s: s["target"]))
        out = base.select(*key_cols, "src_url", F.posexplode(targets).alias("link_pos", "target")) \
            .withColumn("link_pos", F.col("link_pos") + 1)
    else:
        exploded = base.select(*key_cols, "src_url", "_page_nofollow",
                               F.posexplode(links).alias("pos", "l"))
        exploded = exploded.select(
            *key_cols, "src_url", (F.col("pos") + 1).alias("pos"), F.col("l.target").alias("target"),
            F.when(F.col("l.nofollow") | F.col("_page_nofollow"), F.lit(None)).otherwise(
                F.nullif(F.col("l.anchor"), F.lit(""))).alias("anchor"))
        # anchors of one target are grouped on (page, target): a well spread key, no hot group.
        grouped = exploded.groupBy(*key_cols, "src_url", "target").agg(
            F.min("pos").alias("first_pos"),
            F.min_by("anchor", F.when(F.col("anchor").isNotNull(), F.col("pos"))).alias("anchor"),
            F.sort_array(F.collect_list(F.when(F.col("anchor").isNotNull(),
                                               F.struct("pos", "anchor")))).alias("_a"),
        )
        from pyspark.sql import Window
        w = Window.partitionBy(*key_cols).orderBy("first_pos")
        out = grouped.select(*key_cols, "src_url", F.row_number().over(w).alias("link_pos"), "target",
                             "anchor", F.transform("_a", lambda s: s["anchor"]).alias("anchors"))
    if max_per_page >= 0:
        out = cap_per_page(out, max_per_page, key_cols)
    return out


def cap_per_page(links: DataFrame, max_per_page: int, key_cols=("page_id",)) -> DataFrame:
    """Keep the first ``max_per_page`` distinct targets of each page (document order).

    ``link_pos`` is dense (1..n per page) by construction, so the cap is a plain filter that
    runs inside the scan stage: no window, no shuffle.
    """
    return links.filter(F.col("link_pos") <= max_per_page)


def links_to_status(links: DataFrame, metadata: Column | None = None) -> DataFrame:
    """Out-links as DISCOVERED status rows ``(url, metadata, status)``."""
    md = metadata if metadata is not None else F.create_map().cast("map<string,array<string>>")
    return links.select(F.col("target").alias("url"), md.alias("metadata"), F.lit("DISCOVERED").alias("status"))


def redirects(pages: DataFrame, use_canonical: bool = True, ignore_meta_redirect: bool = False,
              url_col: str = "url", key_cols=("page_id",)) -> DataFrame:
    """Redirect status rows.

    Target = canonical link (if enabled) else meta refresh, resolved against the page URL.
    When the target differs from the page: the target becomes DISCOVERED and the page
    REDIRECTION with ``_redirTo``.
    """
    if "tags" not in pages.columns:
        pages = U.materialize(pages, "tags", T.table("html", "link", "meta"))
    refresh = F.lit(None).cast("string") if ignore_meta_redirect else H.meta_refresh_target("tags")
    canon = H.canonical_href("tags") if use_canonical else F.lit(None).cast("string")
    raw = F.coalesce(canon, refresh)
    target = U.resolve(F.col(url_col), raw)
    red = pages.select(*key_cols, F.col(url_col).alias("page_url"), target.alias("target")) \
        .filter(F.col("target").isNotNull() & (F.col("target") != F.col("page_url")))
    # both rows of a page from one scan of it
    rows = F.array(F.struct(F.col("target").alias("url"), F.lit("DISCOVERED").alias("status"),
                            F.lit(None).cast("string").alias("redir_to")),
                   F.struct(F.col("page_url").alias("url"), F.lit("REDIRECTION").alias("status"),
                            F.col("target").alias("redir_to")))
    return red.select(*key_cols, F.explode(rows).alias("_row")).select(*key_cols, "_row.url", "_row.status", "_row.redir_to")


def route_mime(content_type: Column) -> Column:
    """R2: 'html' (also blank), 'xml', 'json' or 'other' from a content type."""
    ct = F.lower(F.coalesce(content_type, F.lit("")))
    return (F.when(ct.contains("html") | (F.trim(ct) == ""), "html")
            .when(ct.contains("xml"), "xml")
            .when(ct.contains("json"), "json")
            .otherwise("other"))


def depth_defaults(md: Column, max_link_depth: int = 5, max_page_link_depth: int = 1) -> Column:
    """Set maxLinkDepth / maxPageLinkDepth when missing."""
    add = F.create_map(
        F.lit("maxLinkDepth"), F.array(F.lit(str(max_link_depth))),
        F.lit("maxPageLinkDepth"), F.array(F.lit(str(max_page_link_depth))))
    # existing values win: put defaults first, the original map last (LAST_WIN dedup policy)
    return F.map_concat(add, md)


def signature(pages: DataFrame, previous: DataFrame | None = None, key: str = "url") -> DataFrame:
    """md5 of the content as ``signature``; with a previous snapshot also ``signature_old``
    and ``changed`` (left join on the key)."""
    cur = pages.withColumn("signature", F.md5(F.col("html")))
    if previous is None:
        return cur
    prev = previous.select(F.col(key), F.col("signature").alias("signature_old"))
    return cur.join(prev, key, "left").withColumn(
        "changed", F.col("signature_old").isNull() | (F.col("signature_old") != F.col("signature")))


def snapshot_changes(old: DataFrame, new: DataFrame, key: str = "url") -> DataFrame:
    """What became of every page between two snapshots: ``signature``, ``signature_old`` and ``change``
    (unchanged, changed, new, gone). Both sides go into the join as key and signature only; a key given
    several times in a snapshot counts with its smallest signature, null keys are left out."""
    def signed(pages):
        return pages.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.md5(F.coalesce("html", F.lit("")))).alias("signature"))

    before = signed(old).withColumnRenamed("signature", "signature_old")
    change = F.when(F.col("signature_old").isNull(), "new").when(F.col("signature").isNull(), "gone") \
        .when(F.col("signature") == F.col("signature_old"), "unchanged").otherwise("changed")
    return signed(new).join(before, key, "full").select(key, "signature", "signature_old", change.alias("change"))


def split_values(md: Column, keys) -> Column:
    """Comma-separated values of the given keys become separate values."""
    keys = list(keys)
    return F.transform_values(md, lambda k, v: F.when(k.isin(*keys), F.flatten(F.transform(
        v, lambda x: F.filter(F.transform(F.split(x, ","), lambda s: F.trim(s)), lambda s: s != "")))).otherwise(v))


def dedup_values(md: Column, keys) -> Column:
    """Distinct values for the configured keys."""
    keys = list(keys)
    return F.transform_values(md, lambda k, v: F.when(k.isin(*keys), F.array_distinct(v)).otherwise(v))


def on_sitemap(md: Column) -> Column:
    """P18: 'true' iff metadata has sitemap.lastModified."""
    return F.map_contains_key(md, F.lit("sitemap.lastModified")).cast("string")


def sub_documents(df: DataFrame, docs_col: str = "documents") -> DataFrame:
    """P20: one row per document found in a page."""
    return df.withColumn("document", F.explode(docs_col)).drop(docs_col)


# Metadata extraction rules per output key, in priority order.
# ("text", element): text of the first such element;
# ("attr", element or "*", match attribute, match value, output attribute): values of all matches.
META_RULES = {
    "canonical": [("attr", "*", "rel", "canonical", "href")],
    "parse.description": [("attr", "meta", "name", "description", "content"),
                          ("attr", "meta", "name", "Description", "content"),
                          ("attr", "meta", "name", "dc:description", "content"),
                          ("attr", "meta", "property", "og:description", "content")],
    "parse.title": [("text", "title"),
                    ("attr", "meta", "name", "title", "content"),
                    ("attr", "meta", "name", "dc:title", "content"),
                    ("attr", "meta", "property", "og:title", "content"),
                    ("text", "h1")],
    "parse.keywords": [("attr", "meta", "name", "keywords", "content"),
                       ("attr", "meta", "name", "meta:keyword", "content"),
                       ("attr", "meta", "name", "dc:subject", "content")],
    "parse.pubdate": [("attr", "*", "property", "article:published_time", "content"),
                      ("attr", "*", "itemprop", "datePublished", "datetime"),
                      ("attr", "*", "itemprop", "datePublished", "content"),
                      ("attr", "*", "name", "OriginalPublicationDate", "content"),
                      ("attr", "*", "property", "og:published_time", "content"),
                      ("attr", "*", "name", "article_date_original", "content"),
                      ("attr", "*", "name", "publication_date", "content"),
                      ("attr", "*", "name", "publish_date", "content"),
                      ("attr", "*", "name", "PublishDate", "content"),
                      ("attr", "*", "name", "sailthru.date", "content"),
                      ("attr", "*", "pubdate", "pubdate", "datetime")],
    "parse.feedlink": [("attr", "link", "type", "application/rss+xml", "href"),
                       ("attr", "link", "type", "application/atom+xml", "href")],
    "parse.meta.language": [("attr", "meta", "name", "language", "content"),
                            ("attr", "meta", "name", "Language", "content"),
                            ("attr", "meta", "name", "LANGUAGE", "content"),
                            ("attr", "meta", "name", "dc.language", "content"),
                            ("attr", "meta", "name", "dc.Language", "content"),
                            ("attr", "meta", "name", "DC.LANGUAGE", "content"),
                            ("attr", "meta", "http-equiv", "content-language", "content"),
                            ("attr", "meta", "http-equiv", "Content-Language", "content"),
                            ("attr", "meta", "http-equiv", "CONTENT-LANGUAGE", "content")],
    "parse.meta.author": [("attr", "meta", "name", "author", "content"),
                          ("attr", "meta", "name", "Author", "content"),
                          ("attr", "meta", "name", "AUTHOR", "content")],
    "parse.meta.copyright": [("attr", "meta", "name", "copyright", "content"),
                             ("attr", "meta", "name", "Copyright", "content"),
                             ("attr", "meta", "name", "COPYRIGHT", "content")],
    "parse.license": [("attr", "*", "rel", "license", "href"),
                      ("attr", "*", "rel", "License", "href"),
                      ("attr", "*", "rel", "LICENSE", "href"),
                      ("attr", "*", "rel", "cc:license", "href"),
                      ("attr", "*", "rel", "cc:License", "href"),
                      ("attr", "*", "rel", "CC:LICENSE", "href"),
                      ("attr", "meta", "name", "dc.license", "content"),
                      ("attr", "meta", "name", "dc.License", "content"),
                      ("attr", "meta", "name", "DC.LICENSE", "content")],
}
SPLIT_KEYS = ["parse.keywords"]
DEDUP_KEYS = ["parse.feedlink", "parse.meta.language", "parse.meta.author", "parse.meta.copyright", "parse.license"]


def rule_values(rule, tags: str = "tags") -> Column:
    """Values one rule yields for a page's tag table (possibly empty array)."""
    if rule[0] == "text":
        return T.elements(tags, rule[1])
    _, element, match_attr, match_value, out_attr = rule
    hits = F.filter(tags, lambda t: (F.lit(element == "*") | (t["name"] == element)) & F.coalesce(T.get(t["attrs"], match_attr) == F.lit(match_value), F.lit(False)))
    return F.filter(F.transform(hits, lambda t: T.get(t["attrs"], out_attr)), lambda v: v.isNotNull())


def extract_meta(pages: DataFrame, rules: dict | None = None, html_col: str = "html",
                 split_keys=SPLIT_KEYS, dedup_keys=DEDUP_KEYS) -> DataFrame:
    """``parse`` metadata map from the rules (first rule with values wins per key),
    comma lists split (P15), configured keys de-duplicated (P16)."""
    rules = rules or META_RULES
    base = pages if "tags" in pages.columns else pages.withColumn("tags", T.table(html_col))
    # the few tags that a rule may match by an attribute
    some = F.array(*[F.lit(a) for a in sorted({r[2] for rs in rules.values() for r in rs if r[0] == "attr"})])
    base = U.materialize(base, "_marked", F.filter("tags", lambda t: F.arrays_overlap(F.map_keys(t["attrs"]), some)))
    entries = []
    for key, rs in rules.items():
        vals = None
        for r in rs:
            v = rule_values(r, "tags" if r[0] == "text" else "_marked")
            vals = F.when(F.size(v) > 0, v) if vals is None else F.coalesce(vals, F.when(F.size(v) > 0, v))
        entries.append(F.struct(F.lit(key).alias("key"), vals.alias("value")))
    md = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))
    md = dedup_values(split_values(md, split_keys), dedup_keys)
    return base.withColumn("parse", md).drop("_marked")
