"""What bounds tasks, driver and shuffles: runs of pages, names that are broadcast, terms that travel."""

import gc
import tracemalloc

import pyarrow as pa
import pytest

from trawl.functions import tags as T
from trawl.operators import embed as E
from trawl.operators import graph as G
from trawl.operators import parse as P


def test_tags_of_a_batch_are_held_in_runs():
    page = "<link rel=canonical href='/a'>" + "<a href='/x' class=c title=t>y</a>" * 40
    pages = pa.array([page, None, ""] * 400)
    build = lambda run: T._table_array([T.tags_of(p, None) for p in run])
    gc.collect()
    tracemalloc.start()
    got = T._in_runs(build, pages)
    runs = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    whole = build([p or "" for p in pages.to_pylist()])
    at_once = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.equals(whole) and runs < at_once / 4
    assert T._in_runs(build, pa.array([], pa.string())).equals(whole.slice(0, 0))


def test_redirects_scan_a_page_once(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.org/1", "<link rel=canonical href='/2'>"), (2, "http://a.org/2", None),
         (3, "http://a.org/3", "<meta http-equiv=refresh content='0;url=/4'><a href='/5'>x</a>")],
        "page_id long, url string, html string")
    got = P.redirects(pages)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Union" not in plan
    assert sorted(map(tuple, got.collect())) == sorted(
        [(1, "http://a.org/2", "DISCOVERED", None), (1, "http://a.org/1", "REDIRECTION", "http://a.org/2"),
         (3, "http://a.org/4", "DISCOVERED", None), (3, "http://a.org/3", "REDIRECTION", "http://a.org/4")])


@pytest.mark.parametrize("graph", [None, "g"])
def test_hits_with_long_names_does_not_broadcast_scores(spark, monkeypatch, graph):
    long = "n" * 1000
    rows = [(i % 7, f"{long}{i % 50}", f"{long}{i % 41 + 20}") for i in range(400)]
    edges = spark.createDataFrame(rows, "g long, src string, dst string")
    def scores(df):
        return {(r.g if graph else 0, r.node): (round(r.hub, 9), round(r.authority, 9)) for r in df.collect()}

    want = scores(G.hits(edges, graph_col=graph))
    sent, broadcast = [], G.F.broadcast
    monkeypatch.setattr(G.F, "broadcast", lambda df: sent.append(df.columns) or broadcast(df))
    got = scores(G.hits(edges, graph_col=graph, max_broadcast_names=10_000))
    assert got == want and not [c for c in sent if "hub" in c]


@pytest.mark.parametrize("hot", [0, 2, 100])
def test_tfidf_is_the_same_for_any_number_of_hot_terms(spark, hot):
    from math import log

    docs = [(1, "the cat the dog"), (2, "The bird"), (2, "the bird sang"), (None, "lone"), (3, None), (4, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.dim): r.weight for r in E.tfidf(df, dims=1_000_003, hot_terms=hot).collect()}
    tf = {(1, "the"): 2, (1, "cat"): 1, (1, "dog"): 1, (2, "the"): 2, (2, "bird"): 2, (2, "sang"): 1, (None, "lone"): 1}
    freq = {t: sum(u == t for _, u in tf) for _, t in tf}
    want = sorted((d, round(n * log(7 / (freq[t] + 1)), 9)) for (d, t), n in tf.items() if d is not None)
    assert sorted((d, round(w, 9)) for (d, _), w in got.items() if d is not None) == want
    assert sum(d is None for d, _ in got) == 1


def test_tfidf_shuffles_texts_by_id_only_once(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b c")], "doc_id long, text string")
    plan = E.tfidf(df)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "hashpartitioning(doc_id" in physical
    assert not any("hashpartitioning(doc_id" in x and "term" in x.split("hashpartitioning(")[1].split(")")[0]
                   for x in physical.splitlines())
