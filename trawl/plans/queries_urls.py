"""URL queries: U1/U2/U4/U6-U13 over page URLs and extracted link targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import urls as U
from trawl.operators.parse import extract_links
from trawl.operators.urlfilter import deny, filter_chain
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.session import configure, load_table


def _pages(spark, sf_dir):
    configure(spark)
    return load_table(spark, sf_dir, "pages")


def _links(spark, sf_dir):
    return extract_links(_pages(spark, sf_dir)).withColumn("link_pos", F.col("link_pos").cast("long"))


def denylist_from_links(links):
    """Deny list derived from the crawl itself: targets on hyphenated (spam-like) hosts are
    'Spam', targets on blog hosts are 'Science' (the exempt label); S8 keeps non-Science rows."""
    h = U.host("url")
    labelled = links.select("url", F.when(h.contains("-"), "Spam").when(h.startswith("blog."), "Science")
                            .alias("label")).filter(F.col("label").isNotNull())
    return labelled.filter(F.lower(F.trim("label")) != "science").select("url", "label")


DENY_SQL = f"""
dn AS (SELECT url, CASE WHEN contains({Q.host('url')}, '-') THEN 'Spam'
                        WHEN starts_with({Q.host('url')}, 'blog.') THEN 'Science' END AS label FROM fl_n),
deny AS (SELECT DISTINCT url FROM dn WHERE label IS NOT NULL AND lower(trim(label)) <> 'science')"""


@register("url_normalise", f"""
SELECT page_id, url, {Q.strip_fragment('url')} AS stripped, {Q.normalise('url')} AS normalised FROM pages
""")
def q_url_normalise(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", "url", U.strip_fragment("url").alias("stripped"), U.normalise("url").alias("normalised"))


@register("url_id", f"""
SELECT page_id, CASE WHEN {Q.is_valid(Q.dot_segments(Q.strip_fragment('url')))}
                     THEN sha256({Q.dot_segments(Q.strip_fragment('url'))}) ELSE 'ERROR' END AS url_id
FROM pages
""")
def q_url_id(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", U.url_id("url").alias("url_id"))


@register("url_host_domain", f"""
SELECT page_id, {Q.host('url')} AS host, {Q.domain('url')} AS domain,
       coalesce({Q.host('url')}, lower(url)) AS key_host,
       coalesce({Q.domain('url')}, {Q.host('url')}, lower(url)) AS key_domain
FROM pages
""")
def q_url_host_domain(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", U.host("url").alias("host"), U.domain("url").alias("domain"),
                    U.partition_key("url", "host").alias("key_host"),
                    U.partition_key("url", "domain").alias("key_domain"))


@register("url_regex_filter", f"""
WITH {Q.links_ctes()}, n AS (SELECT page_id, link_pos, {Q.normalise('target')} AS url FROM lk)
SELECT page_id, link_pos, url, {Q.regex_filter('url')} AS kept FROM n WHERE url IS NOT NULL
""")
def q_url_regex_filter(spark, sf_dir):
    n = _links(spark, sf_dir).select("page_id", "link_pos", U.normalise("target").alias("url"))
    return n.filter(F.col("url").isNotNull()).withColumn("kept", U.regex_filter("url"))


@register("url_basic_filter", f"""
WITH {Q.links_ctes()}, n AS (SELECT page_id, link_pos, {Q.normalise('target')} AS url FROM lk)
SELECT page_id, link_pos, url, {Q.max_path_repetition('url')}::BIGINT AS max_rep, {Q.basic_filter('url')} AS kept
FROM n WHERE url IS NOT NULL
""")
def q_url_basic_filter(spark, sf_dir):
    n = _links(spark, sf_dir).select("page_id", "link_pos", U.normalise("target").alias("url"))
    return n.filter(F.col("url").isNotNull()).select(
        "page_id", "link_pos", "url", U.max_path_repetition("url").cast("long").alias("max_rep"),
        U.basic_filter("url").alias("kept"))


@register("url_epsilon", f"""
WITH {Q.links_ctes()}, {Q.filtered_links_cte(epsilon=0.2)}
SELECT page_id, link_pos, url FROM fl
""")
def q_url_epsilon(spark, sf_dir):
    out = filter_chain(_links(spark, sf_dir), epsilon=0.2)
    return out.select("page_id", "link_pos", "url")


@register("url_chain", f"""
WITH {Q.links_ctes()}, {Q.filtered_links_cte(epsilon=0.2)}, {DENY_SQL}
SELECT page_id, link_pos, url FROM fl WHERE url NOT IN (SELECT url FROM deny)
""")
def q_url_chain(spark, sf_dir):
    links = _links(spark, sf_dir)
    dl = denylist_from_links(links.withColumn("url", U.normalise("target")).filter(F.col("url").isNotNull()))
    out = filter_chain(links, epsilon=0.2, denylist=dl, check_deny_size=False)
    return out.select("page_id", "link_pos", "url")


@register("deny_filter", f"""
WITH {Q.links_ctes()}, {Q.filtered_links_cte()}, {DENY_SQL}
SELECT page_id, link_pos, url FROM fl WHERE url NOT IN (SELECT url FROM deny)
""")
def q_deny_filter(spark, sf_dir):
    links = _links(spark, sf_dir)
    kept = filter_chain(links, steps=("basic", "normalise", "regex", "gz"))
    dl = denylist_from_links(links.withColumn("url", U.normalise("target")).filter(F.col("url").isNotNull()))
    return deny(kept, dl, check_size=False).select("page_id", "link_pos", "url")


@register("same_domain", f"""
WITH {Q.links_ctes()}, n AS (SELECT page_id, link_pos, src_url, {Q.normalise('target')} AS url FROM lk)
SELECT page_id, link_pos, url, coalesce({Q.domain('src_url')} = {Q.domain('url')}, false) AS same_domain
FROM n WHERE url IS NOT NULL
""")
def q_same_domain(spark, sf_dir):
    n = _links(spark, sf_dir).select("page_id", "link_pos", "src_url", U.normalise("target").alias("url"))
    return n.filter(F.col("url").isNotNull()).select("page_id", "link_pos", "url",
                                                     U.same_domain("src_url", "url").alias("same_domain"))


@register("gz_filter", f"""
WITH {Q.links_ctes()}, n AS (SELECT page_id, link_pos, {Q.normalise('target')} AS url FROM lk)
SELECT page_id, link_pos, url, {Q.gz_keep('url')} AS kept FROM n WHERE url IS NOT NULL
""")
def q_gz_filter(spark, sf_dir):
    n = _links(spark, sf_dir).select("page_id", "link_pos", U.normalise("target").alias("url"))
    return n.filter(F.col("url").isNotNull()).withColumn("kept", U.gz_sitemap_keep("url"))
