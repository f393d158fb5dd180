"""Blocks (B1-B5), embeddings (E1-E4) and the flagship entry."""

import math

from pyspark.sql import functions as F

from conftest import SF_SMALL, page_df
from trawl.operators import blocks as B
from trawl.operators import embed as E

HTML = ("<html><head><title>x</title><script>var a=1;</script></head><body><nav><ul><li><a href='/a'>A</a></li>"
        "<li><a href='/b'>B link</a></li></ul></nav><article><h1>Heading of the article</h1>"
        "<p>" + "word " * 30 + "<a href='/in#frag'>inside link</a></p><p>short one</p>"
        "<p>" + "more words here " * 10 + "</p></article><footer>foot note text that is long enough</footer></body></html>")


def test_segmentation_and_content(spark):
    df = page_df(spark, [(1, "http://s.example.com/page", HTML)])
    all_blocks = B.segment_pages(df, min_words=0).orderBy("block_idx").collect()
    assert [b.block_idx for b in all_blocks] == list(range(len(all_blocks)))
    kept = B.segment_pages(df).orderBy("block_idx").collect()
    assert all(b.n_words >= 5 for b in kept)
    big = [b for b in kept if b.n_words > 16]
    assert big and all(b.is_content for b in big)
    assert any(l == "http://s.example.com/in" for b in kept for l in b.links)
    txt = B.page_text(df).first()
    assert txt.content_text == "".join(b.text for b in kept if b.is_content)


def test_pad_windows_cover_whole_text(spark):
    text = " ".join(f"w{i}" for i in range(1300))
    docs = spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")
    w = E.pad_windows(docs).orderBy("doc_id", "window_idx").collect()
    d1 = [r for r in w if r.doc_id == 1]
    assert len(d1) == math.ceil(1300 / 512) and all(len(r.input_ids) == 512 for r in w)
    assert sum(sum(r.attention_mask) for r in d1) == 1300
    d2 = [r for r in w if r.doc_id == 2]
    assert len(d2) == 1 and sum(d2[0].attention_mask) == 0


def test_tfidf_formula(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "b c")], "doc_id long, text string")
    t = E.tfidf(docs, dims=1_000_003).groupBy("doc_id").agg(F.sum("weight").alias("w")).orderBy("doc_id").collect()
    idf = lambda df: math.log(3 / (df + 1))
    assert abs(t[0].w - (2 * idf(1) + 1 * idf(2))) < 1e-9
    assert abs(t[1].w - (1 * idf(2) + 1 * idf(1))) < 1e-9


def test_mean_pool(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 4.0]), (1, [5.0, 6.0])], "label int, embedding array<double>")
    v = {r.label: r.vector for r in E.mean_pool_vectors(df, ["label"]).collect()}
    assert v == {0: [2.0, 3.0], 1: [5.0, 6.0]}


def test_entry_and_catalog(spark):
    import __spark_entry__ as ENTRY
    df = ENTRY.entry(spark)
    assert df.count() > 0 and df.columns == ["url", "host", "status", "next_fetch", "n_sources"]
    q, o = ENTRY.queries(), ENTRY.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 80
    assert ENTRY.queries()["page_links"](spark, SF_SMALL).count() > 0
