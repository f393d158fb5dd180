"""Parsing golden cases: robots directives, nofollow, out-link cap, script links, redirects, text."""

import pytest
from pyspark.sql import functions as F

from conftest import page_df
from trawl.functions import html as H
from trawl.operators import parse as P

TEMPLATE = "<html><head>{meta}<title>t</title></head><body><p>text</p><a href='/x'>x</a></body></html>"

ROBOTS_CASES = [
    ('<META NAME="ROBOTS" CONTENT="NONE">', True, True, True),
    ('<meta name="robots" content="nOnE">', True, True, True),
    ('<Meta Name="Robots" Content="none">', True, True, True),
    ('<meta name="robots" content="all">', False, False, False),
    ('<meta name="robots" content="noindex,nofollow">', True, True, False),
    ('<meta name="robots" content="noindex,follow">', True, False, False),
    ('<meta name="robots" content="index,nofollow">', False, True, False),
    ('<meta name="robots" content="index,follow">', False, False, False),
    ('<meta name="robots">', False, False, False),
]


def test_meta_robots_matrix(spark):
    rows = [(i, "http://example.com/", TEMPLATE.format(meta=m)) for i, (m, *_r) in enumerate(ROBOTS_CASES)]
    df = page_df(spark, rows)
    d = df.select("page_id", P.page_directives(df).alias("d")).select(
        "page_id", H.is_noindex("d").alias("ni"), H.is_nofollow("d").alias("nf"), H.is_nocache("d").alias("nc"))
    got = {r.page_id: (r.ni, r.nf, r.nc) for r in d.collect()}
    for i, (_m, ni, nf, nc) in enumerate(ROBOTS_CASES):
        assert got[i] == (ni, nf, nc), (i, _m)


def test_header_robots_no_links(spark):
    html = "<html><body><a href='/a'>a</a><a href='/b'>b</a></body></html>"
    df = page_df(spark, [(1, "http://example.com/", html, {"X-Robots-Tag": ["noindex", "nofollow"]})], with_md=True)
    d = df.select(P.page_directives(df).alias("d")).first().d
    assert "noindex" in d and "nofollow" in d and "nocache" not in d
    assert P.extract_links(df).count() == 0
    assert df.count() == 1  # the page itself is still emitted


COMPANY = """<html><head><title>Company</title><script>urchinTracker();</script></head><body>
<a href="/about">About</a> <a href="/services">Services</a> <a href="/contact">Contact</a>
<a href="http://other.example.org/partner">Partner</a> <a href="/about">About again</a>
<a href="/news" rel="nofollow">News</a> <a href="/jobs">Jobs</a> <a href="/blog">Blog</a>
<a href="/faq">FAQ</a> <a href="/team">Team</a> <a href="/legal">Legal</a> <a href="/privacy">Privacy</a>
</body></html>"""


def test_nofollow_and_cap(spark):
    df = page_df(spark, [(1, "http://www.company.example.com", COMPANY)])
    links = P.extract_links(df)
    targets = [r.target for r in links.orderBy("link_pos").collect()]
    assert len(targets) == 10  # 12 tags, one duplicate, one rel=nofollow
    assert "http://www.company.example.com/news" not in targets
    assert targets[0] == "http://www.company.example.com/about"
    assert P.extract_links(df, max_per_page=5).count() == 5
    assert P.extract_links(df, max_per_page=-1).count() == 10


def test_non_strict_keeps_nofollow_link_without_anchor(spark):
    df = page_df(spark, [(1, "http://www.company.example.com", COMPANY)])
    links = P.extract_links(df, anchors=True, strict_nofollow=False)
    news = [r for r in links.collect() if r.target.endswith("/news")]
    assert len(news) == 1 and news[0].anchor is None
    about = [r for r in links.collect() if r.target.endswith("/about")][0]
    assert about.anchor == "About" and about.anchors == ["About", "About again"]


def test_javascript_link_dropped(spark):
    html = '<html><body><a href="javascript:void(0)">js</a><a href="mylink">mine</a></body></html>'
    df = page_df(spark, [(1, "http://www.javascriptlinks.com", html)])
    rows = [r.target for r in P.extract_links(df).collect()]
    assert rows == ["http://www.javascriptlinks.com/mylink"]
    st = P.links_to_status(P.extract_links(df)).first()
    assert st.status == "DISCOVERED"


def test_meta_refresh_redirect(spark):
    html = '<html><head><meta http-equiv="refresh" content="0;URL=http://www.somesite.com/site"></head></html>'
    df = page_df(spark, [(1, "http://www.somesite.com", html)])
    rows = {(r.url, r.status) for r in P.redirects(df).collect()}
    assert rows == {("http://www.somesite.com/site", "DISCOVERED"), ("http://www.somesite.com", "REDIRECTION")}


def test_canonical_overrides_refresh(spark):
    html = ('<html><head><link rel="canonical" href="/canon"><meta http-equiv="refresh" '
            'content="5; url=/other"></head></html>')
    df = page_df(spark, [(1, "http://a.example.com/p", html)])
    red = P.redirects(df).filter("status = 'REDIRECTION'").first()
    assert red.redir_to == "http://a.example.com/canon"


def test_visible_text_has_no_script(spark):
    df = page_df(spark, [(1, "http://x.example.com", COMPANY)])
    text = df.select(H.visible_text("html").alias("t")).first().t
    assert "urchinTracker" not in text and "Company" in text


def test_value_dedup_and_split(spark):
    df = spark.createDataFrame([({"key": ["value1", "value2", "value1"], "parse.keywords": ["a, b,c"]},)],
                               "md map<string,array<string>>")
    r = df.select(P.dedup_values(F.col("md"), ["key"]).alias("d"), P.split_values(F.col("md"), ["parse.keywords"]).alias("s")).first()
    assert r.d["key"] == ["value1", "value2"]
    assert r.s["parse.keywords"] == ["a", "b", "c"]


def test_mime_route(spark):
    df = spark.createDataFrame([("text/html",), ("application/xml",), ("application/json",), ("",), ("image/png",)], "ct string")
    got = [r.r for r in df.select(P.route_mime(F.col("ct")).alias("r")).collect()]
    assert got == ["html", "xml", "json", "html", "other"]


def test_meta_extraction_rules(spark):
    html = ('<html><head><title>T1</title><meta name="description" content="D">'
            '<meta name="keywords" content="k1, k2"><link rel="license" href="/lic"></head><body><h1>H</h1></body></html>')
    m = P.extract_meta(page_df(spark, [(1, "http://x.example.com", html)])).first().parse
    assert m["parse.title"] == ["T1"] and m["parse.description"] == ["D"]
    assert m["parse.keywords"] == ["k1", "k2"] and m["parse.license"] == ["/lic"]


@pytest.mark.parametrize("href,expected", [
    ("/a/b", "http://h.example.com/a/b"), ("c", "http://h.example.com/x/c"), ("../d", "http://h.example.com/d"),
    ("?q=1", "http://h.example.com/x/y?q=1"), ("//o.example.org/z", "http://o.example.org/z"),
    ("https://s.example.net/", "https://s.example.net/"), ("./e", "http://h.example.com/x/e"),
])
def test_resolve_matches_urljoin(spark, href, expected):
    from urllib.parse import urljoin

    from trawl.functions import urls as U
    base = "http://h.example.com/x/y"
    got = spark.range(1).select(U.resolve(F.lit(base), F.lit(href)).alias("u")).first().u
    assert got == expected == urljoin(base, href)
