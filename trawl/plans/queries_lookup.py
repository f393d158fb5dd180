"""Lookup queries over ``pages`` with lookup lists derived from the pages themselves:
label_join (S6, J1), set_flag (S7, J2), crawled_anti (J4), embedded_first (J5),
robots_rules / robots_sitemaps (J10), deny_scan (S8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import urls as U
from trawl.operators import lookup as LK
from trawl.operators.links import mark_seen
from trawl.operators.parse import extract_links
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.session import configure, load_table
from trawl.streaming.crawl import known_urls

LANG_RE = r"://[^/]+/([a-z]{2})/"


def _pages(spark, sf_dir):
    configure(spark)
    return load_table(spark, sf_dir, "pages")


def _label_lines(pages):
    """'host,label' lines in page order (label = language folder of the URL, may be blank)."""
    return pages.select(F.concat(U.host("url"), F.lit(","), F.regexp_extract("url", LANG_RE, 1)).alias("value"),
                        F.col("page_id").alias("_n"))


@register("label_join", f"""
WITH {Q.links_ctes()},
lb AS (SELECT {Q.host('url')} AS host, regexp_extract(url, {Q.lit(LANG_RE)}, 1) AS label, page_id FROM pages),
labels AS (SELECT host, arg_max(label, page_id) AS label FROM lb WHERE host <> '' AND label <> '' GROUP BY host)
SELECT lk.page_id, lk.link_pos, lk.target, labels.label AS curlieLabel
FROM lk LEFT JOIN labels ON {Q.host('lk.target')} = labels.host
""")
def q_label_join(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    labels = LK.labels_from_lines(_label_lines(pages))
    links = extract_links(pages).withColumn("link_pos", F.col("link_pos").cast("long"))
    return LK.attach_label(links, labels, url_col="target").select("page_id", "link_pos", "target", "curlieLabel")


@register("set_flag", f"""
WITH dk AS (SELECT DISTINCT {Q.domain("'http://' || " + Q.host('url'))} AS key FROM pages WHERE starts_with({Q.host('url')}, 'www.')),
uk AS (SELECT DISTINCT trim(url) AS key FROM pages WHERE contains(url, 'utm_source'))
SELECT page_id,
       CAST(coalesce({Q.domain('trim(url)')} IN (SELECT key FROM dk), false) AS VARCHAR) AS in_domain_set,
       CAST(coalesce(trim(url) IN (SELECT key FROM uk), false) AS VARCHAR) AS in_url_set
FROM pages
""")
def q_set_flag(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    dom_lines = pages.filter(U.host("url").startswith("www.")).select(F.concat(F.lit("http://"), U.host("url")).alias("value"))
    url_lines = pages.filter(F.col("url").contains("utm_source")).select(F.col("url").alias("value"))
    d = LK.flag_membership(pages.select("page_id", "url"), LK.keys_from(dom_lines, "value", "domain"), "domain",
                           out_col="in_domain_set")
    u = LK.flag_membership(d, LK.keys_from(url_lines, "value", "url"), "url", out_col="in_url_set")
    return u.select("page_id", "in_domain_set", "in_url_set")


@register("crawled_anti", f"""
WITH {Q.links_ctes()},
n AS (SELECT page_id, link_pos, {Q.normalise('target')} AS url FROM lk),
h AS (SELECT DISTINCT {Q.strip_fragment('url')} AS u FROM pages)
SELECT page_id, link_pos, url, CASE WHEN {Q.strip_fragment('url')} IN (SELECT u FROM h) THEN 'FETCHED' ELSE 'DISCOVERED' END AS status
FROM n WHERE url IS NOT NULL
""")
def q_crawled_anti(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    links = extract_links(pages).withColumn("link_pos", F.col("link_pos").cast("long"))
    n = U.materialize(links, "url", U.normalise("target")).filter(F.col("url").isNotNull())
    flagged = mark_seen(n, pages)
    return flagged.select("page_id", "link_pos", "url",
                          F.when(F.col("seen"), "FETCHED").otherwise("DISCOVERED").alias("status"))


@register("embedded_first", f"""
WITH n AS (SELECT page_id, {Q.strip_fragment('url')} AS norm_url FROM pages)
SELECT page_id, norm_url, page_id = min(page_id) OVER (PARTITION BY norm_url) AS first FROM n
""")
def q_embedded_first(spark, sf_dir):
    f = LK.first_seen(_pages(spark, sf_dir).select("page_id", "url"), ["page_id"])
    return f.select("page_id", F.col("_norm").alias("norm_url"), "first")


def _rules(pages):
    hosts = pages.select(U.host("url").alias("host")).distinct()
    rule = F.struct
    arr = F.array_compact(F.array(
        rule(F.lit("/").alias("prefix"), F.lit(True).alias("allow")),
        F.when(F.col("host").startswith("blog."), rule(F.lit("/de/").alias("prefix"), F.lit(False).alias("allow"))),
        F.when(F.col("host").startswith("blog."), rule(F.lit("/de/9").alias("prefix"), F.lit(True).alias("allow"))),
        F.when(F.col("host").contains("-"), rule(F.lit("/").alias("prefix"), F.lit(False).alias("allow"))),
    ))
    r = hosts.select("host", F.explode(arr).alias("r")).select("host", "r.prefix", "r.allow")
    # a later rule with the same prefix replaces the earlier one (spam hosts disallow '/')
    return r.groupBy("host", "prefix").agg(F.min("allow").alias("allow"))


SQL_RULES = f"""hosts AS (SELECT DISTINCT {Q.host('url')} AS host FROM pages),
rules AS (SELECT host, prefix, min(allow) AS allow FROM (
    SELECT host, '/' AS prefix, true AS allow FROM hosts
    UNION ALL SELECT host, '/de/', false FROM hosts WHERE starts_with(host, 'blog.')
    UNION ALL SELECT host, '/de/9', true FROM hosts WHERE starts_with(host, 'blog.')
    UNION ALL SELECT host, '/', false FROM hosts WHERE contains(host, '-')) GROUP BY host, prefix),
pu AS (SELECT page_id, url, {Q.host('url')} AS host, coalesce(nullif({Q.path_of('url')}, ''), '/') AS path FROM pages),
m AS (SELECT pu.page_id, arg_max(r.allow, length(r.prefix)) AS allow FROM pu JOIN rules r ON pu.host = r.host
      WHERE starts_with(pu.path, r.prefix) GROUP BY pu.page_id),
dec AS (SELECT pu.page_id, pu.url, pu.host, coalesce(m.allow, true) AS allowed FROM pu LEFT JOIN m USING (page_id))"""


@register("robots_rules", f"""
WITH {SQL_RULES}
SELECT page_id, url, allowed, CASE WHEN allowed THEN NULL ELSE 'ERROR' END AS status,
       CASE WHEN allowed THEN NULL ELSE 'robots.txt' END AS error_cause FROM dec
""")
def q_robots_rules(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    out, _ = LK.apply_robots(pages.select("page_id", "url"), _rules(pages))
    return out.select("page_id", "url", "allowed", "status", "error_cause")


@register("robots_sitemaps", f"""
WITH {SQL_RULES}
SELECT DISTINCT 'https://' || host || '/sitemap.xml' AS url, 'DISCOVERED' AS status, 'true' AS isSitemap
FROM dec WHERE allowed AND ends_with(host, '.org')
""")
def q_robots_sitemaps(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    hosts = pages.select(U.host("url").alias("host")).distinct()
    sitemaps = hosts.filter(F.col("host").endswith(".org")).select(
        "host", F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap.xml")).alias("sitemap"))
    _, sm = LK.apply_robots(pages.select("page_id", "url"), _rules(pages), sitemaps)
    return sm


@register("deny_scan", f"""
WITH l AS (SELECT page_id, {Q.host('url')} || ',' || CASE WHEN contains(url, '-') THEN 'Spam' WHEN contains(url, 'blog.') THEN ' science ' ELSE 'News,extra' END AS value FROM pages),
p AS (SELECT string_split(value, ',') AS parts FROM l)
SELECT trim(parts[1]) AS url, trim(parts[2]) AS label FROM p WHERE len(parts) = 2 AND lower(trim(parts[2])) <> 'science'
""")
def q_deny_scan(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    label = (F.when(F.col("url").contains("-"), "Spam").when(F.col("url").contains("blog."), " science ")
             .otherwise("News,extra"))
    lines = pages.select(F.concat(U.host("url"), F.lit(","), label).alias("value"))
    return LK.denylist_from_lines(lines)


# Suffix rules over the hosts of ``pages``: whole suffixes, any one label below, an exception.
SUFFIX_RULES = ["com", "org", "net", "example.org", "*.example.net", "!ththre.example.net"]


@register("pay_level_domain", f"""
WITH h AS (SELECT DISTINCT {Q.host('url')} AS host FROM pages),
l AS (SELECT host, string_split(host, '.') AS labels FROM h WHERE host IS NOT NULL),
d AS (SELECT host, CASE
        WHEN ends_with(host, '.ththre.example.net') OR host = 'ththre.example.net' THEN 'ththre.example.net'
        WHEN ends_with(host, '.example.net') AND len(labels) > 3 THEN array_to_string(labels[-4:], '.')
        WHEN ends_with(host, '.example.net') THEN host
        WHEN ends_with(host, '.example.org') THEN array_to_string(labels[-3:], '.')
        WHEN host = 'example.org' THEN host
        ELSE array_to_string(labels[-2:], '.') END AS domain FROM l)
SELECT page_id, url, domain FROM pages LEFT JOIN d ON {Q.host('url')} = d.host
""")
def q_pay_level_domain(spark, sf_dir):
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    return LK.pay_level_domain(_pages(spark, sf_dir).select("page_id", "url"), rules)


@register("robots_wildcards", f"""
WITH p AS (SELECT page_id, url, coalesce(nullif(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)', 1), ''), '/') AS path FROM pages)
SELECT page_id, url, CASE WHEN starts_with(path, '/en/') AND ends_with(path, '1') THEN true
                          ELSE NOT (contains(path, '?') OR starts_with(path, '/en')) END AS allowed
FROM p
""")
def q_robots_wildcards(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    rules = [("/*?", False), ("/en/*1$", True), ("/en", False)]
    table = pages.select(U.host("url").alias("host")).distinct().select("host", F.explode(F.array(*[
        F.struct(F.lit(p).alias("prefix"), F.lit(a).alias("allow")) for p, a in rules])).alias("r")).select("host", "r.*")
    out, _ = LK.apply_robots(pages.select("page_id", "url"), table)
    return out.select("page_id", "url", "allowed")


@register("known_urls", """
WITH a AS (SELECT 'http://u' || user_id || '.example.net/' AS norm_url, ts,
                  lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events)
SELECT norm_url, epoch_us(ts) AS ts_us FROM a WHERE before IS NULL OR ts >= before + INTERVAL 6 HOUR
""")
def q_known_urls(spark, sf_dir):
    """T3 over the arrivals in ``events`` (one URL per user), known for 6 hours after the last one."""
    configure(spark)
    ev = load_table(spark, sf_dir, "events")
    url = F.concat(F.lit("http://u"), F.col("user_id").cast("string"), F.lit(".example.net/#"), F.col("event_type"))
    got = known_urls(ev.select(url.alias("url"), F.col("ts").cast("timestamp").alias("ts")), "6 hours")
    return got.select("norm_url", F.unix_micros("ts").alias("ts_us"))
