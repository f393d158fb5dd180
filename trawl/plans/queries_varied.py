"""The parse and URL rules on pages and links that reach them: directives, redirects, metadata and
nofollow links (P4-P7, P9, P10, P14, P15, P17), all URL filters with metadata (U5, U6, U8, U9, U11,
U12, J4), and rows that carry metadata (P12, P13, P15, P16, P18, P20, A5, M5, R7, U14).

The rows are those of ``pages`` with markup or an address set in by ``page_id``, so that both outcomes of
every rule occur; the jobs are the library's own, over the whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.functions import meta as M
from trawl.functions import urls as U
from trawl.operators import blocks as B
from trawl.operators import frontier as FR
from trawl.operators.links import mark_seen
from trawl.operators.parse import (dedup_values, depth_defaults, extract_links, extract_meta, links_to_status, on_sitemap,
                                   page_directives, redirects, snapshot_changes, split_values, sub_documents, with_tags)
from trawl.operators.relevance import block_relevance_list
from trawl.operators.urlfilter import deny, filter_chain
from trawl.plans.crawl_step import crawl_step, seed_frontier
from trawl.plans.queries_blocks import blocks_sql
from trawl.plans.queries_relevance import SQL_LOF, scored_blocks
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.session import configure, load_table

# What the head of a page gets, by page_id modulo their number ({id}, {url} stand for the page's own).
HEADS = ['<meta name="robots" content="noindex, nofollow">', '<META CONTENT="none" NAME="ROBOTS">',
         '<meta name="robots" content="index,NOCACHE">', '<link rel="canonical" href="/canon/{id}">',
         '<meta http-equiv="refresh" content="5; URL=/next/{id}">',
         '<meta name="keywords" content="tea, coffee,,tea "><meta name="description" content="page {id}">'
         '<meta property="og:title" content="other">', '<link rel="canonical" href="{url}">', '']


def _pages(spark, sf_dir):
    configure(spark)
    p = load_table(spark, sf_dir, "pages")
    n = F.pmod("page_id", F.lit(len(HEADS)))
    head = F.element_at(F.array(*[F.lit(h) for h in HEADS]), (n + 1).cast("int"))
    head = F.replace(F.replace(head, F.lit("{id}"), F.col("page_id").cast("string")), F.lit("{url}"), F.col("url"))
    html = F.replace("html", F.lit("<head>"), F.concat(F.lit("<head>"), head))
    html = F.when(F.col("page_id") % 3 == 0, F.replace(html, F.lit('<li><a href="/t'), F.lit('<li><a rel="nofollow" href="/t'))).otherwise(html)
    return p.select("page_id", "url", html.alias("html"))


_HEAD_SQL = "CASE page_id % 8 " + " ".join(
    f"WHEN {i} THEN replace(replace({Q.lit(h)}, '{{id}}', page_id::VARCHAR), '{{url}}', url)" for i, h in enumerate(HEADS)) + " END"
SQL_V = f"""h AS (SELECT page_id, url, replace(html, '<head>', '<head>' || {_HEAD_SQL}) AS html FROM pages),
v AS (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN replace(html, '<li><a href="/t', '<li><a rel="nofollow" href="/t')
                                ELSE html END AS html FROM h)"""


@register("robots_flags_varied", """
SELECT page_id, page_id % 8 IN (0, 1) AS noindex, page_id % 8 IN (0, 1) AS nofollow, page_id % 8 IN (1, 2) AS nocache,
       CASE page_id % 8 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 0 END::BIGINT AS n_directives
FROM pages
""")
def q_robots_flags(spark, sf_dir):
    p = _pages(spark, sf_dir)
    d = p.select("page_id", page_directives(p).alias("dirs"))
    return d.select("page_id", H.is_noindex("dirs").alias("noindex"), H.is_nofollow("dirs").alias("nofollow"),
                    H.is_nocache("dirs").alias("nocache"), F.size("dirs").cast("long").alias("n_directives"))


_ORIGIN = "regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"


@register("redirects_varied", f"""
WITH r AS (SELECT page_id, url AS page_url, {_ORIGIN} || CASE page_id % 8 WHEN 3 THEN '/canon/' ELSE '/next/' END || page_id AS target
           FROM pages WHERE page_id % 8 IN (3, 4))
SELECT page_id, target AS url, 'DISCOVERED' AS status, NULL::VARCHAR AS redir_to FROM r
UNION ALL
SELECT page_id, page_url, 'REDIRECTION', target FROM r
""")
def q_redirects(spark, sf_dir):
    """A page whose canonical link is its own address is no redirect."""
    return redirects(_pages(spark, sf_dir))


@register("page_meta_varied", """
SELECT page_id, CASE WHEN page_id % 8 = 5 THEN 'tea|coffee|tea' ELSE '' END AS keywords,
       CASE WHEN page_id % 8 = 5 THEN 'page ' || page_id END AS description,
       CASE page_id % 8 WHEN 3 THEN '/canon/' || page_id WHEN 6 THEN url END AS canonical
FROM pages
""")
def q_page_meta(spark, sf_dir):
    m = extract_meta(_pages(spark, sf_dir))
    values = lambda k: F.element_at("parse", F.lit(k))
    return m.select("page_id", F.coalesce(F.array_join(values("parse.keywords"), "|"), F.lit("")).alias("keywords"),
                    F.try_element_at(values("parse.description"), F.lit(1)).alias("description"),
                    F.try_element_at(values("canonical"), F.lit(1)).alias("canonical"))


@register("page_links_varied", f"""
WITH {SQL_V},
a AS (SELECT page_id, url, regexp_extract_all(html, '<a [^>]*href="[^"]*"', 0) AS tags FROM v WHERE page_id % 8 NOT IN (0, 1)),
t AS (SELECT page_id, url, unnest(tags) AS tag, unnest(generate_series(1, len(tags))) AS pos FROM a),
k AS (SELECT page_id, {Q.resolve('url', "regexp_extract(tag, 'href=\"([^\"]*)\"', 1)")} AS target, pos
      FROM t WHERE NOT contains(tag, 'rel="nofollow"')),
f AS (SELECT page_id, target, min(pos) AS pos FROM k WHERE target IS NOT NULL GROUP BY page_id, target)
SELECT page_id, target, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS link_pos FROM f
""")
def q_page_links(spark, sf_dir):
    """Pages that say nofollow give no links; links that say so are left out."""
    links = extract_links(with_tags(_pages(spark, sf_dir)))
    return links.select("page_id", "target", F.col("link_pos").cast("long").alias("link_pos"))


# Addresses by page_id modulo their number ({o} stands for the page's origin), and the metadata of the
# page they were found on.
TARGETS = ["{o}/pics/a.JPG", "{o}/a/b/a/c/a/", "{o}/maps/all.xml.gz", "ftp://files.example.edu/x", "{o}/" + "x" * 1100,
           "http://127.0.0.1:8080/", "http://elsewhere.example.co.uk/", "{o}/plain", "{o}/denied/1"]


def _links(spark, sf_dir):
    configure(spark)
    p = load_table(spark, sf_dir, "pages")
    n = F.pmod("page_id", F.lit(len(TARGETS)))
    origin = F.regexp_extract("url", U.ORIGIN_RE, 1)
    target = F.replace(F.element_at(F.array(*[F.lit(t) for t in TARGETS]), (n + 1).cast("int")), F.lit("{o}"), origin)
    md = F.create_map(F.lit("depth"), F.array((F.col("page_id") % 40).cast("string")),
                      F.lit("isSitemap"), F.array((F.col("page_id") % 2 == 0).cast("string")),
                      F.lit("maxLinkDepth"), F.array(F.when(F.col("page_id") % 5 == 0, "-1").otherwise("3")))
    return p.select("page_id", F.col("url").alias("src_url"), target.alias("target"), md.alias("md"))


_TARGET_SQL = "CASE page_id % 9 " + " ".join(f"WHEN {i} THEN replace({Q.lit(t)}, '{{o}}', {_ORIGIN})" for i, t in enumerate(TARGETS)) + " END"


@register("url_filters_varied", f"""
SELECT page_id, {_TARGET_SQL} AS url, page_id % 9 NOT IN (1, 4) AS basic, page_id % 9 NOT IN (0, 3, 5) AS regex,
       page_id % 9 <> 2 OR page_id % 2 = 0 AS gz, page_id % 9 NOT IN (3, 5, 6) AS same_domain, page_id % 40 <= 20 AS depth
FROM pages
""")
def q_url_filters(spark, sf_dir):
    """Each filter on its own: basic (length, repeated segments), rules, packed sitemaps, domain, depth."""
    ln = _links(spark, sf_dir)
    depth = F.try_element_at(F.element_at("md", F.lit("depth")), F.lit(1)).cast("int") <= 20
    return ln.select("page_id", F.col("target").alias("url"), U.basic_filter("target").alias("basic"), U.regex_filter("target").alias("regex"),
                     U.gz_sitemap_keep("target", F.col("md")).alias("gz"), U.same_domain("src_url", "target").alias("same_domain"),
                     depth.alias("depth"))


@register("url_chain_varied", f"""
SELECT page_id, {_TARGET_SQL} AS url FROM pages
WHERE page_id % 40 <= 20 AND (page_id % 9 = 7 OR (page_id % 9 = 2 AND page_id % 2 = 0)) AND page_id % 5 <> 0
""")
def q_url_chain(spark, sf_dir):
    """The whole chain with the source page's metadata, the source's domain and a deny list."""
    ln = _links(spark, sf_dir)
    listed = ln.where(F.col("target").contains("/denied/")).select(F.col("target").alias("url"))
    kept = filter_chain(ln, source_md=F.col("md"), src_col="src_url", same_domain=True)
    return deny(kept, listed, md=F.col("md")).select("page_id", "url")


@register("crawled_varied", f"""
WITH t AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE url || '/new' END AS url FROM pages),
c AS (SELECT DISTINCT {Q.strip_fragment('url')} AS url FROM pages)
SELECT page_id, CASE WHEN {Q.strip_fragment('url')} IN (SELECT url FROM c) THEN 'FETCHED' ELSE 'DISCOVERED' END AS status FROM t
""")
def q_crawled(spark, sf_dir):
    """Half of the targets were crawled before."""
    configure(spark)
    p = load_table(spark, sf_dir, "pages").select("page_id", "url")
    targets = p.withColumn("target", F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat("url", F.lit("/new"))))
    seen = mark_seen(targets.drop("url"), p.select("url"), "target")
    return seen.select("page_id", F.when(F.col("seen"), "FETCHED").otherwise("DISCOVERED").alias("status"))


@register("snapshot_changes", """
WITH o AS (SELECT url, md5(html) AS signature FROM pages WHERE page_id % 10 <> 0),
n AS (SELECT url, md5(CASE WHEN page_id % 4 = 0 THEN html || '<!-- edited -->' ELSE html END) AS signature FROM pages WHERE page_id % 10 <> 1)
SELECT coalesce(n.url, o.url) AS url, n.signature, o.signature AS signature_old,
       CASE WHEN o.url IS NULL THEN 'new' WHEN n.url IS NULL THEN 'gone' WHEN n.signature = o.signature THEN 'unchanged'
            ELSE 'changed' END AS change
FROM n FULL JOIN o ON n.url = o.url
""")
def q_snapshot_changes(spark, sf_dir):
    """Two versions of ``pages``: some pages missing in each, every fourth edited in the later one."""
    configure(spark)
    p = load_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    later = p.withColumn("html", F.when(F.col("page_id") % 4 == 0, F.concat("html", F.lit("<!-- edited -->"))).otherwise(F.col("html")))
    return snapshot_changes(p.where("page_id % 10 <> 0"), later.where("page_id % 10 <> 1"))


@register("outlink_status", f"""
WITH {Q.links_ctes()}
SELECT page_id, target AS url, 'DISCOVERED' AS status, CASE WHEN page_id % 3 = 0 THEN '7' ELSE '5' END AS max_link_depth,
       '1' AS max_page_link_depth, CASE WHEN page_id % 4 = 0 THEN 'true' ELSE 'false' END AS on_sitemap
FROM lk
""")
def q_outlink_status(spark, sf_dir):
    """Status rows of out-links with the source's metadata, default depths where it has none."""
    configure(spark)
    links = extract_links(load_table(spark, sf_dir, "pages"))
    own = F.when(F.col("page_id") % 3 == 0, F.create_map(F.lit("maxLinkDepth"), F.array(F.lit("7")))).otherwise(M.empty_md())
    dated = F.when(F.col("page_id") % 4 == 0, F.create_map(F.lit("sitemap.lastModified"), F.array(F.lit("2024-01-01")))).otherwise(M.empty_md())
    md = depth_defaults(F.map_concat(own, dated, F.create_map(F.lit("page"), F.array(F.col("page_id").cast("string")))))
    rows = links_to_status(links, md)
    first = lambda k: F.try_element_at(F.element_at("metadata", F.lit(k)), F.lit(1))
    return rows.select(first("page").cast("long").alias("page_id"), "url", "status", first("maxLinkDepth").alias("max_link_depth"),
                       first("maxPageLinkDepth").alias("max_page_link_depth"), on_sitemap(F.col("metadata")).alias("on_sitemap"))


@register("block_flags", f"""
WITH {SQL_LOF}
SELECT page, string_agg(CASE WHEN pred = 1 THEN '1' ELSE '0' END, '' ORDER BY block_idx) AS relevance_flags FROM sb GROUP BY page
""")
def q_block_flags(spark, sf_dir):
    """A5 over the scored vectors."""
    return block_relevance_list(scored_blocks(spark, sf_dir))


@register("value_lists", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'a|b|a' WHEN 1 THEN 'x y' ELSE '' END AS words, 'p|q' AS authors FROM pages
""")
def q_value_lists(spark, sf_dir):
    """P15 and P16 on metadata with lists and repeated values."""
    configure(spark)
    p = load_table(spark, sf_dir, "pages")
    raw = F.when(F.col("page_id") % 3 == 0, "a, b ,,a").when(F.col("page_id") % 3 == 1, "x y").otherwise(" , ")
    md = F.create_map(F.lit("words"), F.array(raw), F.lit("authors"), F.array(F.lit("p"), F.lit("q"), F.lit("p")))
    got = dedup_values(split_values(md, ["words"]), ["authors"])
    joined = lambda k: F.array_join(F.element_at("md", F.lit(k)), "|")
    return p.select("page_id", got.alias("md")).select("page_id", joined("words").alias("words"), joined("authors").alias("authors"))


@register("page_documents", f"""
WITH {Q.links_ctes()}
SELECT page_id, target AS document FROM lk WHERE link_pos <= 3
""")
def q_page_documents(spark, sf_dir):
    """P20: the first three link targets of a page as its documents, one row each."""
    configure(spark)
    links = extract_links(load_table(spark, sf_dir, "pages"), max_per_page=3)
    return sub_documents(links.groupBy("page_id").agg(F.collect_list("target").alias("documents")))


@register("warc_metadata", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'OWS.CURLIELABEL: BOOKS, FOOD' WHEN 1 THEN '' ELSE 'OWS.CURLIELABEL: ' END AS lines FROM pages
""")
def q_warc_metadata(spark, sf_dir):
    """M5: configured metadata as header lines."""
    configure(spark)
    p = load_table(spark, sf_dir, "pages")
    md = F.when(F.col("page_id") % 3 == 0, F.create_map(F.lit("curlieLabel"), F.array(F.lit("Books"), F.lit("food")))) \
        .when(F.col("page_id") % 3 == 2, F.create_map(F.lit("curlieLabel"), F.array(F.lit("")))).otherwise(M.empty_md())
    return p.select("page_id", F.array_join(M.warc_md_lines(md, ["curlieLabel", "other"]), "|").alias("lines"))


@register("fetch_route_plain", """
SELECT event_id, CASE value::BIGINT % 5 WHEN 0 THEN 'parse' ELSE 'status' END AS route,
       CASE value::BIGINT % 5 WHEN 0 THEN 'parse' WHEN 2 THEN 'status+target' ELSE 'status' END AS route_following
FROM (SELECT event_id, floor(value) AS value FROM events)
""")
def q_fetch_route_plain(spark, sf_dir):
    """What follows a fetch when redirects are not followed, beside R3 when they are."""
    configure(spark)
    ev = load_table(spark, sf_dir, "events").select("event_id", F.floor("value").alias("v"))
    code = F.element_at(F.array(*[F.lit(c) for c in (200, 304, 301, 404, 500)]), (F.pmod("v", F.lit(5)) + 1).cast("int"))
    e = ev.withColumn("code", code)
    return e.select("event_id", FR.fetch_route("code", allow_redirects=False).alias("route"), FR.fetch_route("code").alias("route_following"))


@register("uri_escaped", f"""
SELECT page_id, {_ORIGIN} || CASE page_id % 3 WHEN 0 THEN '/a%20b' WHEN 1 THEN '/%C3%A9?q=%E6%97%A5' ELSE '/plain?x=1&y=%25' END AS url FROM pages
""")
def q_uri_escaped(spark, sf_dir):
    """Spaces and letters outside ASCII."""
    configure(spark)
    p = load_table(spark, sf_dir, "pages")
    tail = F.when(F.col("page_id") % 3 == 0, "/a b").when(F.col("page_id") % 3 == 1, "/é?q=日").otherwise("/plain?x=1&y=%25")
    return p.select("page_id", U.uri_escape(F.concat(F.regexp_extract("url", U.ORIGIN_RE, 1), tail)).alias("url"))


@register("crawl_step_varied", f"""
WITH {SQL_V},
w AS (SELECT page_id, {Q.normalise('url')} AS url, replace(html, '<p>', '<p><a href="/deep/' || page_id || '">w</a> ') AS html FROM v),
due AS (SELECT page_id, url, row_number() OVER (PARTITION BY {Q.host('url')} ORDER BY url) <= 30 AS due FROM w),
{blocks_sql(B.MIN_WORDS).replace("FROM pages", "FROM w")},
deep AS (SELECT DISTINCT {_ORIGIN} || '/deep/' || blk.page_id AS url FROM blk WHERE is_content AND contains(raw, '/deep/')
         AND page_id IN (SELECT page_id FROM due WHERE due AND page_id % 8 NOT IN (3, 4))),
moved AS (SELECT {_ORIGIN} || CASE page_id % 8 WHEN 3 THEN '/canon/' ELSE '/next/' END || page_id AS url FROM due WHERE due AND page_id % 8 IN (3, 4))
SELECT url, CASE WHEN NOT due THEN 'DISCOVERED' WHEN page_id % 8 IN (3, 4) THEN 'REDIRECTION' ELSE 'FETCHED' END AS status FROM due
UNION ALL SELECT url, 'DISCOVERED' FROM deep UNION ALL SELECT url, 'DISCOVERED' FROM moved
""")
def q_crawl_step(spark, sf_dir):
    """One step over pages with redirects and with links in their paragraphs: the status of every URL after it."""
    p = _pages(spark, sf_dir)
    link = F.concat(F.lit('<p><a href="/deep/'), F.col("page_id").cast("string"), F.lit('">w</a> '))
    p = p.withColumn("html", F.replace("html", F.lit("<p>"), link))
    corpus = load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return crawl_step(p, seed_frontier(p, now), corpus, now).select("url", "status")
