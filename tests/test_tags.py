"""Golden pages of the tag scan and what reads it: links, directives, metadata, blocks."""

import pytest

from conftest import page_df
from trawl.functions import tags as T
from trawl.operators import blocks as B
from trawl.operators import parse as P

PAGE = """<!DOCTYPE html><HTML lang=de><head><title>Tea &amp;lt; Caf&eacute;</title>
<META NAME='Keywords' content="x"><meta name=keywords content='tea, coffee ,,cups'>
<meta property="og:title" content="other"><link rel="license" href=/lic?a=1&amp;b=2>
<script>document.write("<a href='/in-script'>no</a>");</script><style>a:after{content:"<a href='/in-style'>"}</style></head>
<body data-href="/not-a-link"><!-- <a href="/in-comment">no</a> -->
<a href=/plain>Plain <b>bold</b></a><a data-href="/other" title="<a href='/in-title'>">none</a>
<A title="x > y" HREF = '/quoted?p=1&amp;q=2' >Quoted</A> <a href=it's>Stray quote</a>
<a href="/nf" rel=NOFOLLOW>nf</a><a href>Empty</a> 1 < 2 <a href='/num&#38;&#x41;'>&#128512;</a>
<h1>First <i>head</i></h1><h1>Second</h1></body></html>"""


def test_links_of_a_real_page(spark):
    rows = P.extract_links(page_df(spark, [(1, "http://shop.example.net/de/", PAGE)]), anchors=True).orderBy("link_pos").collect()
    base = "http://shop.example.net"
    assert [(r.target, r.anchor) for r in rows] == [
        (base + "/plain", "Plain bold"), (base + "/quoted?p=1&q=2", "Quoted"), (base + "/de/it's", "Stray quote"),
        (base + "/de/", "Empty"), (base + "/num&A", "😀")]


def test_metadata_of_a_real_page(spark):
    md = P.extract_meta(page_df(spark, [(1, "http://shop.example.net/de/", PAGE), (2, "http://x.example/", None)])) \
        .orderBy("page_id").select("parse").collect()
    assert md[0].parse == {"parse.title": ["Tea &lt; Café"], "parse.keywords": ["tea", "coffee", "cups"],
                           "parse.license": ["/lic?a=1&b=2"]}
    assert md[1].parse == {}
    heads = {"parse.title": [("text", "h2"), ("text", "h1")]}
    got = P.extract_meta(page_df(spark, [(1, "u", PAGE)]), rules=heads).first().parse
    assert got == {"parse.title": ["First head", "Second"]}


@pytest.mark.parametrize("meta, flags", [
    ('<meta content=none name=robots>', ["noindex", "nofollow", "nocache"]),
    ('<meta name="otherrobots" content="noindex">', ["noindex"]),
    ('<meta name=robots><meta name=robots content="nofollow">', ["nofollow"]),
    ('<!-- <meta name=robots content=none> -->', [])])
def test_directives(spark, meta, flags):
    df = page_df(spark, [(1, "http://x.example/", f"<head>{meta}</head>")])
    assert df.select(P.page_directives(df).alias("d")).first().d == flags


def test_redirect_targets(spark):
    html = ["<link href='/c' rel=Canonical>", '<meta http-equiv=REFRESH content="3; URL=\'/r\'">', "<script><link rel=canonical href=/s></script>"]
    df = page_df(spark, [(i, "http://x.example/p", h) for i, h in enumerate(html)])
    got = {(r.page_id, r.status): r.url for r in P.redirects(df).collect()}
    assert got == {(0, "DISCOVERED"): "http://x.example/c", (0, "REDIRECTION"): "http://x.example/p",
                   (1, "DISCOVERED"): "http://x.example/r", (1, "REDIRECTION"): "http://x.example/p"}


def test_one_table_serves_all(spark):
    df = P.with_tags(page_df(spark, [(1, "http://shop.example.net/de/", PAGE)]))
    assert P.extract_links(df).count() == 5
    assert "parse.title" in P.extract_meta(df).first().parse


def test_blocks_of_a_real_page(spark):
    html = """<head><title>Gone</title></head><body><p class="a>b">One two &amp; three <a href=/l>four five</a> six
    <script>if (a</p> 3) x("<p>")</script> seven<br>eight<!-- <p> --> nine</p><div>1 < 2</div><head><p>late head</p></head>"""
    rows = B.segment_pages(page_df(spark, [(1, "http://x.example/", html)]), min_words=0).orderBy("block_idx").collect()
    assert [(r.text, r.n_words, round(r.link_density, 3), r.links) for r in rows] == [
        ("One two & three four five six seven", 8, 0.25, ["http://x.example/l"]), ("eight nine", 2, 0.0, []), ("1 < 2", 3, 0.0, [])]


def test_long_pages_and_broken_markup():
    assert T.tags_of("", None) == [] and T.tags_of("<", None) == [] and T.tags_of("<a", None) == []
    assert T.tags_of("<a href=\"never closed>text", None)[0][0] == "a"
    many = "<p " + "a='1' " * 100_000 + ">" + "<" * 100_000 + "<!--" + "-" * 100_000
    assert T.tags_of(many, None) == [("p", {"a": "1"}, "")]
    assert T.pieces_of("<div>" * 50_000 + "x", frozenset(["div"])) == [("x", 1, 0, [])]


def test_links_are_put_back(spark):
    html = """<head><a href=/no>head</a></head><body>Go <a href="/a#x">to <b>A</b></a>, <a name=n>not a link</a><a href='mailto:x'></a>!
    <p>Say |LINK_1| and |LINK_99| <a href=b>|LINK_0|<div>block</div></a> end<a href=c>open"""
    rows = B.blocks_with_links(page_df(spark, [(1, "http://x.example/p/q", html), (2, "http://y.example/", None)])).orderBy("block_idx").collect()
    assert [(r.annotated, r.text, r.links) for r in rows] == [
        ("Go |LINK_0| , not a link |LINK_1| !", "Go to A , not a link !", ["http://x.example/a", "mailto:x"]),
        ("Say |LINK_1| and |LINK_99| |LINK_2| end |LINK_3|", "Say and |LINK_99| |LINK_0| block end open",
         ["mailto:x", "http://x.example/p/b", "http://x.example/p/c"])]
