"""Golden cases of registrable domains, robots rules, dot segments and decoding."""

import pytest
from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.functions import urls as U
from trawl.operators import lookup as L

DOMAINS = {"http://www.bbc.co.uk/news": "bbc.co.uk", "https://a.b.example.org:8080/x": "example.org", "http://co.uk/": "co.uk",
           "http://example.com": "example.com", "http://10.1.2.3/x": "10.1.2.3", "http://localhost/": "localhost",
           "http://a.b.shop.ck/": "b.shop.ck", "http://shop.ck/": "shop.ck", "http://x.www.ck/": "www.ck", "http://www.ck/": "www.ck",
           "http://WWW.Uni.AC.UK/": "uni.ac.uk", "http://notco.uk/": "notco.uk"}


def test_pay_level_domains(spark, tmp_path):
    df = spark.createDataFrame([(u,) for u in DOMAINS] + [(None,), ("mailto:x",)], "url string")
    assert {r.url: r.d for r in df.select("url", U.domain("url").alias("d")).collect()} == DOMAINS | {None: None, "mailto:x": None}
    file = tmp_path / "suffixes.dat"
    file.write_text("// comment\n\ncom\nuk\n  co.uk  two words\nac.uk\norg\n*.ck\n!www.ck\n")
    rules = L.read_suffixes(spark, str(file))
    assert sorted(r.rule for r in rules.collect()) == sorted(["com", "uk", "co.uk", "ac.uk", "org", "*.ck", "!www.ck"])
    assert {r.url: r.domain for r in L.pay_level_domain(df, rules).collect()} == DOMAINS | {None: None, "mailto:x": None}
    assert U.SUFFIXES and len(U.SUFFIXES) < 200


@pytest.mark.parametrize("rules, path, allowed", [
    ([("/private", False)], "/private/x", False), ([("/private", False)], "/public", True),
    ([("/*.pdf$", False)], "/a/b.pdf", False), ([("/*.pdf$", False)], "/a/b.pdf?x", True), ([("/*.pdf", False)], "/a/b.pdf?x", False),
    ([("/a*c", False), ("/a", True)], "/abbc/d", False), ([("/a", False), ("/a/b", True)], "/a/b/c", True),
    ([("/same", False), ("/same", True)], "/same", True), ([("/same", True), ("/same", False)], "/same", True),
    ([("", False)], "/x", True), ([("/*?sort=", False)], "/list?a=1&sort=up", True), ([("/*sort=", False)], "/list?a=1&sort=up", False),
    ([("/$", False)], "/", False), ([("/$", False)], "/x", True), ([("/a.b", False)], "/axb", True),
    ([("/*\\E.*", False)], "/x", True), ([("/", False)], "", False)])
def test_robots_rules(spark, rules, path, allowed):
    urls = spark.createDataFrame([(1, "http://h.example.net" + path)], "id int, url string")
    table = spark.createDataFrame([("h.example.net", p, a) for p, a in rules], "host string, prefix string, allow boolean")
    got, _ = L.apply_robots(urls, table)
    assert got.first().allowed is allowed


def test_dot_segments(spark):
    cases = {"http://h/a/./b/../c": "http://h/a/c", "http://h/a/b/../../../c": "http://h/../c", "http://h/a/..": "http://h/",
             "http://h/a/b/.": "http://h/a/b/", "http://h/a?x=/../y": "http://h/a?x=/../y", "http://h/a#/./b": "http://h/a#/./b",
             "http://h/1/2/3/4/../../../../x": "http://h/x", "http://h": "http://h", "http://h/..": "http://h/..",
             "http://h/a/...": "http://h/a/...", "/a/../b": "/b"}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.v for r in df.select("u", U.remove_dot_segments("u").alias("v")).collect()} == cases


def test_decoding_is_lenient(spark):
    rows = [(1, "é".encode("latin-1"), "ISO-8859-1", "é"), (2, b"ab\xffc", "UTF-8", "ab�c"), (3, "日本".encode("shift_jis"), "Shift_JIS", "日本"),
            (4, "é".encode(), "no-such-charset", "é"), (5, "é".encode(), None, "é"), (6, b"", "utf-8", ""), (7, None, "utf-8", None),
            (8, b"x", "rot13", "x"), (9, "ж".encode("cp1251"), "WINDOWS-1251", "ж"), (10, b"\xe9", "zip", "�")]
    df = spark.createDataFrame([r[:3] for r in rows], "id int, c binary, cs string")
    got = {r.id: r.t for r in df.select("id", H.decode_content(F.col("c"), F.col("cs")).alias("t")).collect()}
    assert got == {r[0]: r[3] for r in rows}
