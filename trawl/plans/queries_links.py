"""Link queries: crawl_next (flagship), page_links (P2), links_capped (P11), anchor_first."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.plans.crawl_next import crawl_next
from trawl.operators.parse import extract_links
from trawl.session import configure, load_table


def _pages(spark, sf_dir):
    configure(spark)
    return load_table(spark, sf_dir, "pages")


@register("crawl_next", f"""
WITH {Q.links_ctes()}, {Q.filtered_links_cte()}
SELECT url, {Q.host('url')} AS host, 'DISCOVERED' AS status,
       {Q.fmt_ts("date_trunc('minute', " + Q.ts_from_seconds(Q.relevance_seconds('0.0')) + ")")} AS next_fetch,
       count(DISTINCT page_id) AS n_sources
FROM fl GROUP BY url
""")
def q_crawl_next(spark, sf_dir):
    return crawl_next(_pages(spark, sf_dir))


@register("page_links", f"""
WITH {Q.links_ctes()}
SELECT page_id, src_url, link_pos, target FROM lk
""")
def q_page_links(spark, sf_dir):
    return extract_links(_pages(spark, sf_dir)).withColumn("link_pos", F.col("link_pos").cast("long"))


@register("links_capped", f"""
WITH {Q.links_ctes()}
SELECT page_id, src_url, link_pos, target FROM lk WHERE link_pos <= 5
""")
def q_links_capped(spark, sf_dir):
    return extract_links(_pages(spark, sf_dir), max_per_page=5).withColumn("link_pos", F.col("link_pos").cast("long"))


@register("anchor_first", f"""
WITH {Q.links_ctes()},
an AS (SELECT page_id, target, arg_min(anchor, pos) FILTER (WHERE anchor IS NOT NULL) AS anchor,
              count(anchor) AS n_anchors
       FROM lk_raw GROUP BY page_id, target)
SELECT lk.page_id, lk.link_pos, lk.target, an.anchor, an.n_anchors
FROM lk JOIN an ON lk.page_id = an.page_id AND lk.target = an.target
""")
def q_anchor_first(spark, sf_dir):
    links = extract_links(_pages(spark, sf_dir), anchors=True)
    return links.select("page_id", F.col("link_pos").cast("long").alias("link_pos"), "target", "anchor",
                        F.size("anchors").cast("long").alias("n_anchors"))


@register("crawl_step")
def q_crawl_step(spark, sf_dir):
    """Entry 1 over the whole tables: seeds = every page URL, fetched content = ``pages``,
    corpus = ``embeddings``; returns the next frontier (rows-only check: a composition of the
    operators that have their own oracles)."""
    from trawl.plans.crawl_step import crawl_step, seed_frontier

    pages = _pages(spark, sf_dir)
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    frontier = seed_frontier(pages.select("url"), now)
    corpus = load_table(spark, sf_dir, "embeddings")
    nxt = crawl_step(pages, frontier, corpus, now, scorer="cosine", threshold=0.0)
    return nxt.select("url", "key", "status", F.date_format("next_fetch", "yyyy-MM-dd HH:mm:ss").alias("next_fetch"))
