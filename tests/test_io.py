"""Readers, writers, metadata functions, registry and the crawl step on small files."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trawl import registry
from trawl.functions import meta as M
from trawl.functions import urls as U
from trawl.operators import frontier as FR
from trawl.operators import parse as P
from trawl.sinks import writers as WR
from trawl.sources import readers as RD


def test_seeds_prefix_targets_vocab(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text(" http://a.example.com/ \n\nhttp://b.example.com/x\n")
    s = RD.read_seeds(spark, str(tmp_path / "seeds.txt")).collect()
    assert [(r.url, r.status) for r in s] == [("http://a.example.com/", "DISCOVERED"), ("http://b.example.com/x", "DISCOVERED")]
    paths = spark.createDataFrame([("crawl/a.warc.gz",)], "value string")
    assert RD.prefix_paths(paths, "s3a://bucket/").first().path == "s3a://bucket/crawl/a.warc.gz"
    (tmp_path / "vocab.txt").write_text("hello 5\nworld 7\n")
    assert {r.token: r.id for r in RD.read_vocab(spark, str(tmp_path / "vocab.txt")).collect()} == {"hello": 5, "world": 7}
    (tmp_path / "vec.txt").write_text("0.5 1.5  -2\n9 9 9\n")
    assert RD.read_vector_text(spark, str(tmp_path / "vec.txt")).first().vector == [0.5, 1.5, -2.0]
    (tmp_path / "t.txt").write_text("http://t.example.com/\n")
    assert RD.read_targets(spark, str(tmp_path / "t.txt")).count() == 1


def test_sitemap_xml(spark, tmp_path):
    (tmp_path / "sm.xml").write_text(
        '<?xml version="1.0"?><urlset><url><loc> http://a.example.com/1 </loc><lastmod>2024-01-02</lastmod></url>'
        "<url><loc>http://a.example.com/2</loc></url></urlset>")
    rows = {r.url: r for r in RD.read_sitemaps(spark, str(tmp_path / "sm.xml")).collect()}
    assert set(rows) == {"http://a.example.com/1", "http://a.example.com/2"}
    flag = spark.createDataFrame([(rows["http://a.example.com/1"].metadata,)], "md map<string,array<string>>") \
        .select(P.on_sitemap(F.col("md")).alias("f")).first().f
    assert flag == "true"


def test_index_tables_and_corpus(spark, tmp_path):
    paths = WR.create_index_tables(spark, str(tmp_path / "idx"))
    assert set(paths) == {"status", "content", "metrics"}
    assert RD.read_index(spark, paths["metrics"], "metrics").columns[:3] == ["name", "task_id", "component"]
    c = RD.read_corpus(spark, f"{SF_SMALL}/embeddings.parquet")
    assert c.count() > 0 and dict(c.dtypes)["embedding"] == "array<double>"


def test_status_log_and_graph_and_eval_writers(spark, tmp_path):
    st = spark.createDataFrame([("http://a.example.com/", "FETCHED", None, {"k": ["v"]}, "a.example.com")],
                               "url string, status string, next_fetch timestamp, metadata map<string,array<string>>, key string")
    WR.write_status_log(st, str(tmp_path / "log"), F.lit(dt.datetime(2024, 1, 1)))
    line = spark.read.text(str(tmp_path / "log")).first().value
    assert line.split()[1:] == ["FETCHED", "-", "DEFAULT", "http://a.example.com/", "a.example.com", '{"k":["v"]}']
    assert line.startswith(" " * 4 + "2024-01-01T00:00:00.000Z")
    e = spark.createDataFrame([("a", "b"), ("a", "c")], "src string, dst string")
    WR.write_graph(e, str(tmp_path / "g"))
    assert json.loads(spark.read.text(str(tmp_path / "g")).first().value) == {"a": ["b", "c"]}
    ev = spark.createDataFrame([("u", True, 1, 1, 1.0)], "url string, is_relevant boolean, cum_relevant long, cum_total long, harvest_rate double")
    WR.write_evaluation_log(ev, str(tmp_path / "ev"))
    assert spark.read.text(str(tmp_path / "ev")).count() == 5
    WR.null_sink(e)


def test_metadata_functions(spark):
    df = spark.createDataFrame([({"a": ["1"], "isX": ["true"], "parse.t": ["x"], "depth": ["2"], "url.path": ["p0"]},)],
                               "md map<string,array<string>>")
    r = df.select(
        M.merge_md(F.col("md"), F.create_map(F.lit("Content-Type"), F.array(F.lit("text/html"))), "protocol.").alias("m1"),
        M.add_value(F.col("md"), "a", "2").alias("m2"), M.set_value(F.col("md"), "a", "9").alias("m3"),
        M.remove_key(F.col("md"), "a").alias("m4"), M.select_md(F.col("md"), M.PERSIST_KEYS).alias("m5"),
        M.inherit_md(F.col("md"), F.lit("http://parent/")).alias("m6"), M.warc_md_lines(
            F.create_map(F.lit("robots"), F.array(F.lit("noindex"), F.lit("nofollow"))), ["robots", "canonical"]).alias("w"),
        P.depth_defaults(F.col("md")).alias("d")).first()
    assert r.m1["protocol.Content-Type"] == ["text/html"] and r.m1["a"] == ["1"]
    assert r.m2["a"] == ["1", "2"] and r.m3["a"] == ["9"] and "a" not in r.m4
    assert set(r.m5) == {"isX", "parse.t"}
    assert r.m6["url.path"] == ["p0", "http://parent/"] and r.m6["depth"] == ["3"] and "a" not in r.m6
    assert r.w == ["OWS.ROBOTS: NOINDEX, NOFOLLOW"]
    assert r.d["maxLinkDepth"] == ["5"] and r.d["maxPageLinkDepth"] == ["1"]


def test_frontier_pull_lease_and_flatten(spark):
    now = dt.datetime(2024, 1, 1, 12)
    rows = [(f"http://h{i % 3}.example.com/{i}", f"h{i % 3}", {}, "DISCOVERED", now - dt.timedelta(minutes=i), None)
            for i in range(40)] + [("http://h0.example.com/late", "h0", {}, "DISCOVERED", now + dt.timedelta(days=1), None)]
    fr = spark.createDataFrame(rows, "url string, key string, metadata map<string,array<string>>, status string, next_fetch timestamp, leased_until timestamp")
    out = FR.due_urls(fr, F.lit(now), max_queues=2, max_per_queue=5)
    got = out.collect()
    assert len(got) == 10 and len({r.key for r in got}) == 2
    assert all(r.leased_until == now + dt.timedelta(seconds=300) for r in got)
    leased = FR.apply_lease(fr, out)
    assert FR.due_urls(leased, F.lit(now), max_queues=2, max_per_queue=5).join(out, "url").count() == 0
    vals = spark.createDataFrame([([("k", ["a", "b"])],)], "values array<struct<key:string,values:array<string>>>")
    assert vals.select(FR.frontier_to_pages(vals).alias("m")).first().m == {"k": ["a", "b"]}


def test_upsert_rule(spark):
    t = spark.createDataFrame([("u1", "FETCHED", 1), ("u2", "FETCHED", 1)], "url string, status string, ts int")
    u = spark.createDataFrame([("u1", "DISCOVERED", 5), ("u2", "ERROR", 5), ("u3", "DISCOVERED", 5), ("u3", "FETCH_ERROR", 6)],
                              "url string, status string, ts int")
    got = {r.url: r.status for r in FR.upsert_status(t, u).collect()}
    assert got == {"u1": "FETCHED", "u2": "ERROR", "u3": "FETCH_ERROR"}


def test_registry_chain_and_uri_escape(spark):
    links = spark.createDataFrame([("http://a.example.com/", "http://a.example.com/x"),
                                   ("http://a.example.com/", "http://b.example.org/y.jpg"),
                                   ("http://a.example.com/", "ftp://a.example.com/z")], "src_url string, url string")
    out = registry.apply_url_filters(links, [("basic", {}), ("regex", {}), ("same_domain", {})])
    assert [r.url for r in out.collect()] == ["http://a.example.com/x"]
    u = spark.createDataFrame([("http://a.example.com/é x",)], "url string").select(U.uri_escape("url").alias("u")).first().u
    assert u == "http://a.example.com/%C3%A9%20x"


def test_crawl_step_smoke(spark):
    from trawl.plans.crawl_step import crawl_step, seed_frontier
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    now = F.lit(dt.datetime(2024, 1, 1))
    fr = seed_frontier(pages.select("url"), now)
    corpus = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    nxt = crawl_step(pages, fr, corpus, now).collect()
    st = {r.status for r in nxt}
    assert "FETCHED" in st and len(nxt) >= fr.count()


def test_sub_documents_and_page_report(spark):
    df = spark.createDataFrame([(1, ["d1", "d2"])], "page_id long, documents array<string>")
    assert P.sub_documents(df).count() == 2
    sc = spark.createDataFrame([("p", 0, 0.5, 1)], "page string, block_idx long, score double, pred int")
    from trawl.operators import relevance as R
    rep = WR.page_debug_report(sc, R.segment_stats(sc), R.page_stats(sc)).collect()
    assert any(r.line.startswith("pred: 1 score: 0.500000") for r in rep) and len(rep) == 1 + 4 + 1
    assert os.path.exists(SF_SMALL)


def test_politeness_threads(spark):
    urls = spark.createDataFrame([(f"http://a.example.com/{i}", "a.example.com") for i in range(5)]
                                 + [(f"http://b.example.org/{i}", "b.example.org") for i in range(4)], "url string, key string")
    delays = spark.createDataFrame([("a.example.com", 2.0)], "key string, delay double")
    p = FR.politeness_plan(urls, delays, order=("url",), min_delay=0.5, thread_rules=[(r"\.org$", 2)])
    got = {r.url: (r.queue_pos, r.slot_s) for r in p.collect()}
    assert got["http://a.example.com/4"] == (5, 8.0)   # 1 thread, 2 s apart
    assert got["http://b.example.org/3"] == (4, 0.5)   # 2 threads, min delay: floor(3/2) * 0.5
