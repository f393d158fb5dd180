"""Streaming forms equal their batch forms on the same rows (availableNow triggers)."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trawl.operators import evaluate as EV
from trawl.operators import graph as G
from trawl.operators.parse import extract_links
from trawl.plans.crawl_next import crawl_next
from trawl.streaming import crawl as ST


def split_pages(spark, tmp_path, parts=3):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    d = str(tmp_path / "pages_in")
    for i in range(parts):
        pages.filter(F.floor(F.col("page_id") * parts / 50) == i).coalesce(1).write.mode("append").parquet(d)
    return pages, d


def test_crawl_loop_equals_batch(spark, tmp_path):
    pages, d = split_pages(spark, tmp_path)
    q = ST.crawl_loop(spark, d, str(tmp_path / "status"), str(tmp_path / "ck"), pages.schema)
    q.awaitTermination(300)
    got = ST.read_status(spark, str(tmp_path / "status"))
    exp = crawl_next(pages)
    assert sorted(r.url for r in got.collect()) == sorted(r.url for r in exp.collect())


def test_first_seen_stream(spark, tmp_path):
    pages, d = split_pages(spark, tmp_path)
    s = ST.first_seen_stream(spark.readStream.schema(pages.schema).parquet(d))
    q = s.writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.sql("select norm_url from firsts").collect()
    from trawl.functions import urls as U
    exp = pages.select(U.strip_fragment("url").alias("n")).distinct().count()
    assert len(got) == exp == len({r.norm_url for r in got})


def test_metric_stream(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    m = ev.select(F.col("event_type").alias("name"), F.col("ts").cast("timestamp").alias("ts"), "value")
    d = str(tmp_path / "m")
    m.repartition(2).write.parquet(d)
    s = ST.metric_stream(spark.readStream.schema(m.schema).parquet(d), 10, delay="0 seconds")
    q = s.writeStream.format("memory").queryName("mb").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    from trawl.operators.monitor import metric_buckets
    exp = metric_buckets(m, 10)
    got = spark.sql("select * from mb")
    # append mode emits only buckets closed by the watermark: everything but the newest ones
    assert 0 < got.count() <= exp.count()
    assert got.join(exp, ["bucket", "name", "n"]).count() == got.count()


def test_evaluation_loop(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "n_chars", "lang")
    docs = docs.withColumn("url", F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))) \
        .withColumn("is_relevant", F.col("lang") == "en")
    d = str(tmp_path / "docs")
    for i in range(2):
        docs.filter(F.floor(F.col("doc_id") / 100) == i).coalesce(1).write.mode("append").parquet(d)
    q = ST.evaluation_loop(spark, d, str(tmp_path / "ev"), str(tmp_path / "ck2"), docs.schema, ["doc_id"],
                           "is_relevant")
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "ev")).orderBy("doc_id").select("doc_id", "harvest_rate").collect()
    exp = EV.evaluate(docs, ["doc_id"], "is_relevant").orderBy("doc_id").select("doc_id", "harvest_rate").collect()
    # file order = arrival order = doc_id order here
    assert [round(r.harvest_rate, 9) for r in got] == [round(r.harvest_rate, 9) for r in exp]


def test_hits_window_loop(spark, tmp_path):
    pages, d = split_pages(spark, tmp_path, parts=2)
    q = ST.hits_window_loop(spark, d, str(tmp_path / "edges"), str(tmp_path / "scores"), str(tmp_path / "ck3"),
                            pages.schema, window=20)
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "scores"))
    win = G.count_windows(pages, "page_id", 20)
    links = extract_links(win.select("page_id", "url", "html")).join(win.select("page_id", "graph"), "page_id")
    exp = G.hits(links.select("graph", F.col("src_url").alias("src"), F.col("target").alias("dst")), graph_col="graph")
    complete = pages.count() // 20
    exp = exp.filter(F.col("graph") < complete)
    j = got.join(exp, ["graph", "node"])
    assert got.count() == exp.count() == j.count()
    assert j.filter(F.abs(got.hub - exp.hub) > 1e-9).count() == 0
    assert os.path.isdir(str(tmp_path / "edges"))


def test_known_urls_expire_when_idle(spark, tmp_path):
    """Literal arrivals over three batches and a restart: each arrival renews a URL's span of 30 minutes."""
    files = [[("http://h/a#x", 0), ("http://h/b", 0), ("http://h/b", 10), (None, 0)], [("http://h/a", 20), ("http://h/c", 35)],
             [("http://h/a#y", 45), ("http://h/b", 45), ("http://h/c", 65), ("http://h/a", 74)]]
    want = {("http://h/a", 0, False), ("http://h/b", 0, False), ("http://h/b", 10, True), ("http://h/a", 20, True),
            ("http://h/c", 35, False), ("http://h/a", 45, True), ("http://h/b", 45, False), ("http://h/c", 65, False),
            ("http://h/a", 74, True)}
    schema, d = "url string, ts timestamp", str(tmp_path / "in")
    table = lambda rows: spark.createDataFrame([(u, m) for u, m in rows], "url string, m int").select(
        "url", F.timestamp_seconds(F.col("m") * 60 + 1_700_000_000).alias("ts"))
    minute = ((F.unix_timestamp("ts") - 1_700_000_000) / 60).cast("int").alias("m")
    for n, rows in enumerate(files):
        table(rows).coalesce(1).write.mode("append").parquet(d)
        s = ST.known_urls_stream(spark.readStream.schema(schema).parquet(d), "30 minutes")
        q = s.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination(300)  # a new query on the state of the one before
    got = spark.read.parquet(str(tmp_path / "out")).select("norm_url", minute, "known").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    batch = ST.known_urls(table([r for f in files for r in f]), "30 minutes").select("norm_url", minute).collect()
    assert {tuple(r) for r in batch} == {w[:2] for w in want if not w[2]}
