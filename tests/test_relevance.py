"""LOF / cosine / kNN against numpy brute force; segment statistics cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.operators import relevance as R


def brute_lof(corpus, queries, k=8, exclude_self=False):
    def knn(x, skip=None):
        d = np.sqrt(((corpus - x) ** 2).sum(axis=1))
        if skip is not None:
            d[skip] = np.inf
        idx = np.lexsort((np.arange(len(corpus)), d))[:k]
        return idx, d[idx]

    nn = [knn(corpus[i], i) for i in range(len(corpus))]
    kd = np.array([d[-1] for _, d in nn])
    lrd = np.array([1.0 / (np.maximum(d, kd[idx]).mean() + 1e-10) for idx, d in nn])
    out = []
    for j, q in enumerate(queries):
        idx, d = knn(q, j if exclude_self else None)
        lrd_q = 1.0 / (np.maximum(d, kd[idx]).mean() + 1e-10)
        out.append(1.5 - lrd[idx].mean() / lrd_q)
    return np.array(out)


def vec_df(spark, mat, start=0):
    return spark.createDataFrame([(int(i + start), [float(x) for x in v]) for i, v in enumerate(mat)],
                                 "vec_id long, embedding array<double>")


def test_lof_two_clusters_and_outlier(spark):
    rng = np.random.default_rng(7)
    corpus = np.vstack([rng.normal(0, 0.1, (30, 4)), rng.normal(5, 0.1, (30, 4))])
    queries = np.vstack([rng.normal(0, 0.1, (3, 4)), [[20.0, 20, 20, 20]]])
    s = R.lof_score(vec_df(spark, queries, 1000), vec_df(spark, corpus), k=8).orderBy("vec_id").toPandas()
    exp = brute_lof(corpus, queries)
    assert np.allclose(s.raw_score.to_numpy(), exp, atol=1e-9)
    assert s.pred.iloc[3] == -1 and s.raw_score.iloc[3] < s.raw_score.iloc[:3].min() - 1.0


def test_lof_leave_one_out_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 6))
    df = vec_df(spark, m)
    s = R.lof_score(df, df, k=8, exclude_self=True).orderBy("vec_id").toPandas()
    assert np.allclose(s.raw_score.to_numpy(), brute_lof(m, m, exclude_self=True), atol=1e-9)


def test_lof_needs_k_plus_one(spark):
    df = vec_df(spark, np.eye(5))
    with pytest.raises(ValueError):
        R.lof_fit(df, k=8)


def test_cosine_max_and_chunked_corpus(spark):
    rng = np.random.default_rng(1)
    q, c = rng.normal(size=(20, 5)), rng.normal(size=(50, 5))
    c[0] = 0.0  # zero norm never wins
    qn = q / np.linalg.norm(q, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        sims = qn @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T
    exp = np.nanmax(np.where(np.isfinite(sims), sims, np.nan), axis=1)
    for bound in (10_000, 7):  # broadcast in one piece, or blocked co-groups of ~7 corpus vectors
        got = R.max_cosine(vec_df(spark, q), vec_df(spark, c, 100), max_broadcast=bound).orderBy("vec_id").toPandas()
        assert np.allclose(got.best_sim.to_numpy(), exp, atol=1e-12)


def test_knn_chunked_equals_single(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(40, 3))
    df = vec_df(spark, m)
    a = R.knn(df, df, k=5, exclude_self=True).orderBy("vec_id", "rank").toPandas()
    b = R.knn(df, df, k=5, exclude_self=True, max_broadcast=9).orderBy("vec_id", "rank").toPandas()
    assert (a.nn_id.to_numpy() == b.nn_id.to_numpy()).all()
    assert np.allclose(a.dist.to_numpy(), b.dist.to_numpy())


@pytest.mark.parametrize("n", [0, 3, 4, 7, 8])
def test_segments(spark, n):
    rows = [("p", i, float(i), 1 if i % 2 else -1) for i in range(n)]
    df = spark.createDataFrame(rows, "page string, block_idx long, score double, pred int")
    seg = R.segment_stats(df).orderBy("segment").collect()
    if n == 0:
        assert seg == []
    elif n < 4:
        assert len(seg) == 4 and all(r.seg_sum == 0.0 and r.seg_mean is None for r in seg)
    else:
        z = n // 4
        assert len(seg) == 4
        for s in seg:
            idx = range(s.segment * z, (s.segment + 1) * z)
            assert s.seg_sum == pytest.approx(sum(idx))
        tail = sum(range(4 * z, n))
        total = df.agg(F.sum("score")).first()[0]
        assert sum(s.seg_sum for s in seg) + tail == pytest.approx(total)


def test_page_stats(spark):
    df = spark.createDataFrame([("p", 0, 0.5, 1), ("p", 1, -0.25, -1), ("p", 2, 0.25, 1)],
                               "page string, block_idx long, score double, pred int")
    r = R.page_stats(df).first()
    assert r.num_blocks == 3 and r.num_relevant == 2
    assert r.page_relevance == pytest.approx(0.75) and r.info_sum == pytest.approx(0.25)
    assert r.score_var == pytest.approx(np.var([0.5, -0.25, 0.25]))


def test_block_relevance_list(spark):
    df = spark.createDataFrame([("p", 2, 1), ("p", 0, -1), ("p", 1, 1)], "page string, block_idx long, pred int")
    assert R.block_relevance_list(df).first().relevance_flags == "011"


def test_blocked_knn_with_few_queries_and_ties(spark):
    from trawl.operators.relevance import knn

    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 6))
    x[:60] = x[0]
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for ids in ([5], [5, 200], list(range(300))):
        q = df.where(F.col("vec_id").isin(ids))
        want = sorted(map(str, knn(q, df, 8).collect()))
        assert sorted(map(str, knn(q, df, 8, max_broadcast=100).collect())) == want
    first = knn(df.where("vec_id = 200"), df.where("vec_id < 60"), 8).collect()
    assert [r.nn_id for r in sorted(first, key=lambda r: r["rank"])] == list(range(8))
