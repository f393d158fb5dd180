"""URL filters and lookups: gz sitemap (C3), regex rules (C4), label / set lookups (C5), deny list."""

from pyspark.sql import functions as F

from trawl.functions import urls as U
from trawl.operators import lookup as LK


def test_gz_sitemap(spark):
    """A packed sitemap is followed from a page that is itself a sitemap, whatever the letter case."""
    packed, plain = "http://shop.test/maps/all.XML.gz", "http://shop.test/maps/all.xml?v=2"
    pages = {"no metadata": None, "other key": {"depth": ["1"]}, "not a map": {"isSitemap": ["false"]}, "map": {"isSitemap": ["TRUE", "x"]}}
    df = spark.createDataFrame([(n, u, m) for n, m in pages.items() for u in (packed, plain)],
                               "page string, url string, md map<string,array<string>>")
    got = {(r.page, r.url): r.k for r in df.select("page", "url", U.gz_sitemap_keep("url", F.col("md")).alias("k")).collect()}
    assert {k for k, v in got.items() if not v} == {(n, packed) for n in pages if n != "map"}
    assert df.select(U.gz_sitemap_keep("url").alias("k")).where("k").count() == 4  # without metadata: the plain ones


def test_regex_rules(spark):
    """The first rule that matches decides: schemes, sitemaps before file endings, local and numeric hosts."""
    kept = ["http://town.test/", "https://town.test/a.html?img=b.png2", "http://town.test/feed.xml", "http://town.test/m.xml.gz?x",
            "http://10.town.test/", "http://town.test/tar/gz"]
    dropped = ["mailto:mayor@town.test", "file:///etc/hosts", "http://town.test/logo.PNG", "http://town.test/a.tgz&b=1",
               "https://localhost:81/x", "http://127.9.9.9", "http://192.168.0.1:80/a", "http://[::1]/"]
    df = spark.createDataFrame([(u,) for u in kept + dropped], "url string")
    assert [r.url for r in df.where(U.regex_filter("url")).collect()] == kept


def test_basic_filter_and_chain_idempotent(spark):
    df = spark.createDataFrame([("http://a.example.com/x/x/x/y",), ("http://a.example.com/x/y/x",), ("http://a.example.com/" + "a" * 1100,)], "url string")
    assert [r.k for r in df.select(U.basic_filter("url").alias("k")).collect()] == [False, True, False]
    n1 = df.select(U.normalise("url").alias("u"))
    n2 = n1.select(U.normalise("u").alias("u"))
    assert sorted(n1.collect()) == sorted(n2.collect())


def test_label_lookup(spark, tmp_path):
    """The last line of a host counts; other hosts, also of the same domain, have no label."""
    p = tmp_path / "labels.csv"
    p.write_text("host,label\nlib.town.test,Books\nbakery.test , Food\nlib.town.test, Reading\nalone\n")
    labels = LK.read_labels(spark, str(p))
    want = {"http://lib.town.test/opening?day=1": "Reading", "https://LIB.town.test:8443/": "Reading", "http://bakery.test": "Food",
            "http://town.test/": None, "http://alone/": None, "no url": None}
    urls = spark.createDataFrame([(u,) for u in want], "url string")
    assert {r.url: r.curlieLabel for r in LK.attach_label(urls, labels).collect()} == want


def test_set_membership(spark, tmp_path):
    """By domain any host below it is a member, by URL only the same text."""
    p = tmp_path / "keys.txt"
    p.write_text("https://shop.bakery.co.uk/cakes\n\n  town.test  \nhttp://10.0.0.7/a\n")
    by_domain = {"http://bakery.co.uk": "true", "http://other.co.uk": "false", "http://a.b.town.test/x": "true",
                 "http://10.0.0.7/z": "true", "http://7.test/": "false", "https://shop.bakery.co.uk/cakes": "true", "town": "false"}
    urls = spark.createDataFrame([(u,) for u in by_domain], "url string")
    flagged = lambda mode: {r.url: r.isCurlieDomain for r in LK.flag_membership(
        urls, LK.read_keys(spark, str(p), mode), mode).collect()}
    assert flagged("domain") == by_domain
    assert [u for u, f in flagged("url").items() if f == "true"] == ["https://shop.bakery.co.uk/cakes"]


def test_denylist(spark, tmp_path):
    p = tmp_path / "deny.csv"
    p.write_text("http://spam.example.com/,Spam\nhttp://sci.example.org/, science \nhttp://x.example.com/,a,b\n")
    d = LK.read_denylist(spark, str(p))
    assert [r.url for r in d.collect()] == ["http://spam.example.com/"]
    from trawl.operators.urlfilter import deny
    links = spark.createDataFrame([("http://spam.example.com/",), ("http://ok.example.com/",)], "url string")
    assert [r.url for r in deny(links, d).collect()] == ["http://ok.example.com/"]
