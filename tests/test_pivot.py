"""Pivot-cell search against brute force: clustered, uniform, repeated and unusable vectors, both forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.operators import pivot
from trawl.operators.relevance import knn, max_cosine


def table(spark, m, ids=None):
    return spark.createDataFrame([(int(i), None if v is None else [None if x is None else float(x) for x in v])
                                  for i, v in zip(ids if ids is not None else range(len(m)), m, strict=True)],
                                 "vec_id long, embedding array<double>").repartition(4)


def brute(q, q_ids, c, c_ids, k, exclude_self):
    out = {}
    for i, v in zip(q_ids, q, strict=True):
        d = np.sqrt(((c - v) ** 2).sum(1))
        order = [j for j in np.lexsort((c_ids, d)) if not (exclude_self and c_ids[j] == i)][:k]
        out[int(i)] = [(int(c_ids[j]), round(float(d[j]), 9)) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("vec_id", "rank").collect():
        out.setdefault(r.vec_id, []).append((r.nn_id, round(r.dist, 9)))
    return out


def clusters(rng, n, dim=8, centres=25):
    at = rng.normal(0, 10, (centres, dim))
    return at[rng.integers(0, centres, n)] + rng.normal(0, 0.2, (n, dim))


@pytest.mark.parametrize("bound", [10_000, 150])
@pytest.mark.parametrize("kind", ["clustered", "uniform", "equal"])
def test_equals_brute_force(spark, bound, kind):
    rng = np.random.default_rng(11)
    m = {"clustered": lambda: clusters(rng, 900), "uniform": lambda: rng.normal(size=(900, 8)),
         "equal": lambda: np.vstack([np.ones((500, 8)), rng.normal(size=(400, 8))])}[kind]()
    ids = rng.permutation(900)
    df = table(spark, m, ids)
    got = knn(df, df, 8, exclude_self=True, max_broadcast=bound, report=True)
    assert found(got) == brute(m, ids, m, ids, 8, True)
    if kind == "clustered" and bound > 900:
        assert got.agg(F.avg("cells")).first()[0] < 0.4 * np.ceil(np.sqrt(900))  # of 30 cells
    few = df.where("vec_id < 3")
    assert found(knn(few, df, 3, max_broadcast=bound)) == brute(m[ids < 3], ids[ids < 3], m, ids, 3, False)


@pytest.mark.parametrize("bound", [10_000, 5])
def test_unusable_vectors_take_no_part(spark, bound):
    rng = np.random.default_rng(2)
    m = list(rng.normal(size=(40, 3)))
    bad = {3: None, 7: [1.0, None, 2.0], 9: [float("nan"), 0, 0], 12: [float("inf"), 0, 0], 15: [0.0, 0.0, 0.0]}
    df = table(spark, [bad.get(i, v) for i, v in enumerate(m)])
    use = [i for i in range(40) if i not in bad or i == 15]
    c = np.array([[0.0] * 3 if i == 15 else m[i] for i in use])
    assert found(knn(df, df, 4, exclude_self=True, max_broadcast=bound)) == brute(c, use, c, np.array(use), 4, True)
    best = {r.vec_id: r.best_sim for r in max_cosine(df, df, exclude_self=True, max_broadcast=bound).collect()}
    assert len(best) == 40 and all(best[i] == -1.0 for i in bad)  # a zero vector has no direction
    live = [i for i in range(40) if i not in bad]
    for i in live:
        sims = [m[i] @ m[j] / np.linalg.norm(m[i]) / np.linalg.norm(m[j]) for j in live if j != i]
        assert best[i] == pytest.approx(max(sims), abs=1e-12)


def test_fewer_rows_than_neighbours_and_none(spark):
    df = table(spark, np.eye(3))
    for bound in (10, 1):
        got = found(knn(df, df, 8, exclude_self=True, max_broadcast=bound))
        assert [len(v) for v in got.values()] == [2, 2, 2]
    assert knn(df, df.where("vec_id > 9"), 8).count() == 0
    assert {r.best_sim for r in max_cosine(df, df.where("vec_id > 9")).collect()} == {-1.0}


def test_bounds_hold_for_every_row(spark):
    """No row is nearer than its ring's bound, none of the k nearest beyond the first reach."""
    rng = np.random.default_rng(5)
    c, q = clusters(rng, 600, 5), clusters(rng, 50, 5)
    index = pivot.Index(np.arange(600), c, c[:20].copy(), 4)
    d, home = index.cells.home(q)
    low, reach = index.cells.bound(d, home), index.cells.first_reach(d, 4)
    dist = pivot.distances(q, index.m)
    for n, (a, b) in enumerate(zip(index.start, index.stop, strict=True)):
        assert (dist[:, a:b].min(1) >= low[:, n] - 1e-9).all()
    assert (np.sort(dist, 1)[:, 3] <= reach).all()


def test_corpus_without_directions(spark):
    zero = table(spark, np.zeros((3, 2)))
    assert {r.best_sim for r in max_cosine(table(spark, np.eye(2)), zero).collect()} == {-1.0}
    assert {r.best_sim for r in max_cosine(table(spark, np.eye(2)), zero, max_broadcast=1).collect()} == {-1.0}


def test_blocks_of_distances_stay_small():
    import tracemalloc

    from trawl.operators.pivot import Found

    rng = np.random.default_rng(5)
    q, m = rng.normal(size=(4096, 16)), rng.normal(size=(8192, 16))
    found = Found(np.arange(4096), q, 8, True)
    tracemalloc.start()
    found.look(np.arange(4096), np.arange(8192), m)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    row, _, nn, _ = found.nearest()
    some = rng.choice(4096, 20, replace=False)
    d = ((q[some, None] - m[None]) ** 2).sum(2)
    d[np.arange(20), some] = np.inf
    assert [sorted(nn[row == x]) for x in some] == [sorted(x) for x in np.argsort(d, axis=1)[:, :8]]


def test_one_split_of_queries_is_spread(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(300)], "vec_id long, embedding array<double>")
    got = knn(df.coalesce(1), df, 3, exclude_self=True)
    assert got.select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism


def test_vectors_beyond_the_square_root_of_the_range(spark):
    rows = [(0, [1e200, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [2.5, 0.0]), (4, [4.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r["rank"]): r.nn_id for r in knn(df, df, 1, exclude_self=True).where("vec_id > 0").collect()}
    assert got == {(1, 1): 2, (2, 1): 3, (3, 1): 2, (4, 1): 3}
