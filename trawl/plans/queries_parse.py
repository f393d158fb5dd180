"""Parse queries over ``pages``: robots flags (P6/P7), redirects (P9/P10), MIME route (R2),
metadata extraction (P14-P16), signature (P17), visible text (P19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.operators.parse import META_RULES, extract_meta, page_directives, redirects, route_mime
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.session import configure, load_table


def _pages(spark, sf_dir):
    configure(spark)
    return load_table(spark, sf_dir, "pages")


@register("robots_flags", f"""
WITH d AS (SELECT page_id, {Q.meta_directives('html')} AS dirs FROM pages)
SELECT page_id, list_contains(dirs, 'noindex') AS noindex, list_contains(dirs, 'nofollow') AS nofollow,
       list_contains(dirs, 'nocache') AS nocache, len(dirs)::BIGINT AS n_directives
FROM d
""")
def q_robots_flags(spark, sf_dir):
    p = _pages(spark, sf_dir)
    d = p.select("page_id", page_directives(p).alias("dirs"))
    return d.select("page_id", H.is_noindex("dirs").alias("noindex"), H.is_nofollow("dirs").alias("nofollow"),
                    H.is_nocache("dirs").alias("nocache"), F.size("dirs").cast("long").alias("n_directives"))


def _canon_sql():
    tags = f"regexp_extract_all(html, {Q.lit(r'(?is)<link' + chr(92) + r's[^>]*>')}, 0)"
    canon = f"list_filter({tags}, lambda t: coalesce(lower({Q.attr('t', 'rel')}) = 'canonical', false))"
    href = f"trim({Q.attr('(' + canon + ')[1]', 'href')})"
    return f"(CASE WHEN {href} <> '' THEN {href} END)"


def _refresh_sql():
    tags = f"regexp_extract_all(html, {Q.lit(H.META_TAG_RE)}, 0)"
    ref = f"list_filter({tags}, lambda t: coalesce(lower({Q.attr('t', 'http-equiv')}) = 'refresh', false))"
    content = Q.attr(f"({ref})[1]", "content")
    tgt = f"trim(regexp_extract({content}, {Q.lit(r'''(?i)^\s*\d*\s*;\s*url\s*=\s*['"]?([^'"]+)''')}, 1))"
    return f"(CASE WHEN {tgt} <> '' THEN {tgt} END)"


@register("redirects", f"""
WITH r AS (SELECT page_id, url AS page_url, {Q.resolve('url', 'coalesce(' + _canon_sql() + ', ' + _refresh_sql() + ')')} AS target
           FROM pages),
k AS (SELECT * FROM r WHERE target IS NOT NULL AND target <> page_url)
SELECT page_id, target AS url, 'DISCOVERED' AS status, NULL::VARCHAR AS redir_to FROM k
UNION ALL
SELECT page_id, page_url AS url, 'REDIRECTION' AS status, target AS redir_to FROM k
""")
def q_redirects(spark, sf_dir):
    return redirects(_pages(spark, sf_dir))


CT_SQL = ("CASE WHEN contains(url, '.html') THEN 'text/html; charset=utf-8' WHEN contains(url, '?') "
          "THEN 'application/json' WHEN ends_with(url, '/') THEN 'application/xml' ELSE '' END")


@register("mime_route", f"""
WITH c AS (SELECT page_id, {CT_SQL} AS content_type FROM pages)
SELECT page_id, content_type,
       CASE WHEN contains(lower(content_type), 'html') OR trim(lower(content_type)) = '' THEN 'html'
            WHEN contains(lower(content_type), 'xml') THEN 'xml'
            WHEN contains(lower(content_type), 'json') THEN 'json' ELSE 'other' END AS route
FROM c
""")
def q_mime_route(spark, sf_dir):
    p = _pages(spark, sf_dir)
    ct = (F.when(F.col("url").contains(".html"), "text/html; charset=utf-8")
          .when(F.col("url").contains("?"), "application/json")
          .when(F.col("url").endswith("/"), "application/xml").otherwise(""))
    c = p.select("page_id", ct.alias("content_type"))
    return c.withColumn("route", route_mime(F.col("content_type")))


def _n_keys_sql():
    return " + ".join(f"(CASE WHEN {Q.meta_key(k)} IS NOT NULL THEN 1 ELSE 0 END)" for k in META_RULES)


@register("page_meta", f"""
SELECT page_id, {Q.meta_key('parse.title')}[1] AS title, {Q.meta_key('parse.description')}[1] AS description,
       {Q.meta_key('canonical')}[1] AS canonical,
       array_to_string(list_filter(flatten(list_transform({Q.meta_key('parse.keywords')},
            lambda x: list_transform(string_split(x, ','), lambda s: trim(s)))), lambda s: s <> ''), ', ') AS keywords,
       ({_n_keys_sql()})::BIGINT AS n_keys
FROM pages
""")
def q_page_meta(spark, sf_dir):
    m = extract_meta(_pages(spark, sf_dir))
    md = F.col("parse")

    def first(k):
        return F.try_element_at(F.element_at(md, F.lit(k)), F.lit(1))

    return m.select("page_id", first("parse.title").alias("title"), first("parse.description").alias("description"),
                    first("canonical").alias("canonical"),
                    F.array_join(F.element_at(md, F.lit("parse.keywords")), ", ").alias("keywords"),
                    F.size(F.map_keys(md)).cast("long").alias("n_keys"))


@register("page_signature", "SELECT page_id, url, md5(html) AS signature FROM pages")
def q_page_signature(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", "url", F.md5("html").alias("signature"))


@register("visible_text", f"SELECT page_id, {Q.visible_text('html')} AS text FROM pages")
def q_visible_text(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", H.visible_text("html").alias("text"))


@register("decode_charset", f"""
SELECT page_id, upper(nullif(regexp_extract(html, {Q.lit(r'''(?i)<meta[^>]+charset\s*=\s*["']?([A-Za-z0-9_.:-]+)''')}, 1), '')) AS charset,
       length(html)::BIGINT AS n_chars, md5(html) AS text_md5
FROM pages
""")
def q_decode_charset(spark, sf_dir):
    """P1 over raw bytes: the stored pages are encoded to bytes, the charset is read from the
    document head, and the bytes are decoded again (round trip = the original text)."""
    p = _pages(spark, sf_dir)
    raw = p.select("page_id", F.encode("html", "UTF-8").alias("content"))
    view = F.decode("content", "ISO-8859-1")  # ASCII-safe view of the page
    cs = H.declared_charset(html_head=view)
    text = H.decode_content(F.col("content"), cs)
    return raw.select("page_id", cs.alias("charset"), F.length(text).cast("long").alias("n_chars"),
                      F.md5(text).alias("text_md5"))
