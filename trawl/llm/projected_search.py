"""Nearest neighbours by low-dimensional stable projections in a kd-tree (operator 8).

Vectors are lengthened by one component to a common norm, which turns the largest inner product
into the smallest Euclidean distance, and projected by ``DIMS`` Gaussian (2-stable) directions.
Rows are dealt by id hash into shards of about ``SHARD_ROWS``; each shard holds a kd-tree over its
projected points. For a query, leaves are visited in order of projected distance and their rows
verified by exact inner products, until the chi-square test holds: a row nearer than the k-th found
would, with probability ``CONFIDENCE``, have a projected distance below that of the next leaf.
Queries go to every shard in blocks, the shards' best are merged per query.

Every row is indexed and every shard searched; the test replaces no candidate list and has no cap.
Defined results: vectors null, empty, zero, or with null or non-finite components, rows with a null
id, and rows of another length than the most frequent take no part; of rows with one id the smallest
vector stands; fewer candidates than ``k``: all of them; an empty table gives an empty result.
"""

from __future__ import annotations

from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.store import persist

DIMS, LEAF, SHARD_ROWS, BLOCK_QUERIES, CONFIDENCE, SEED = 8, 32, 4096, 256, 0.96, 20
SCHEMA = "query_id long, vec_id long, score double"


def chi_square_cdf(x: np.ndarray, dims: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    h = np.asarray(x) / 2
    return 1 - np.exp(-h) * sum(h**i / factorial(i) for i in range(dims // 2))


class ProjectedTree:
    """kd-tree (leaves only: rows in leaf order and the leaves' boxes) over projected vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm2: float, seed: int = SEED):
        self.norm2 = norm2
        self.dirs = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, DIMS))
        rest = np.sqrt(np.maximum(norm2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        p = vectors @ self.dirs[:-1] + rest[:, None] * self.dirs[-1]
        leaves, todo = [], [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            axis = int(np.ptp(p[rows], axis=0).argmax())
            half = len(rows) // 2
            rows = rows[np.argpartition(p[rows, axis], half)]
            todo += [rows[half:], rows[:half]]
        self.bounds = np.cumsum([0, *(len(x) for x in leaves)])
        order = np.concatenate(leaves)
        self.ids, self.vectors = ids[order], vectors[order]
        self.low = np.array([p[x].min(0) for x in leaves])
        self.high = np.array([p[x].max(0) for x in leaves])

    def search(self, query: np.ndarray, own: int, k: int, confidence: float = CONFIDENCE):
        """(ids, inner products) of the k best found."""
        at = query @ self.dirs[:-1]
        gap = np.maximum(np.maximum(self.low - at, at - self.high), 0)
        dist2 = (gap**2).sum(1)
        leaves = np.argsort(dist2, kind="stable")
        best_i, best_s = np.zeros(0, np.int64), np.zeros(0)
        done, step, base = 0, 8, self.norm2 + query @ query
        while done < len(leaves):
            take = leaves[done:done + step]
            rows = np.concatenate([np.arange(self.bounds[x], self.bounds[x + 1]) for x in take])
            i, s = self.ids[rows], self.vectors[rows] @ query
            i, s = np.concatenate((best_i, i[i != own])), np.concatenate((best_s, s[i != own]))
            if len(s) > k:
                top = np.lexsort((i, -s))[:k]
                i, s = i[top], s[top]
            best_i, best_s = i, s
            done += len(take)
            if done < len(leaves) and len(s) >= k:
                kth = max(base - 2 * s.min(), 1e-12)
                if chi_square_cdf(dist2[leaves[done]] / kth, DIMS) >= confidence:
                    break
        return best_i, best_s


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the rows that take part, vectors as double arrays."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")) \
        .where("vec_id is not null and size(v) > 0") \
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))) \
        .where(F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each row whose id ``every`` divides."""
    rows = persist(valid(vectors), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    head = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("m")) \
        .orderBy(F.desc("n"), "dims").limit(1).first()
    if head is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, norm2 = head.dims, float(head.m)
    rows = rows.where(F.size("v") == dims)
    shards = max(1, -(-head.n // SHARD_ROWS))
    shard_of = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def bundle(name):
        """Consecutive rows of a group as one row: group, ids, vectors."""
        def task(batches):
            last, ids, vs = None, [], []

            def out():
                return pa.RecordBatch.from_arrays(
                    [pa.array([last], pa.int32()), pa.array([np.concatenate(ids).astype("<i8").tobytes()], pa.binary()),
                     pa.array([np.concatenate(vs).astype("<f8").tobytes()], pa.binary())],
                    [name, name + "_ids", name + "_vectors"])

            for b in batches:
                g, i = b.column(0).to_numpy(), b.column(1).to_numpy()
                v = b.column(2).flatten().to_numpy().reshape(-1, dims)
                cut = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1), len(g)]
                for x, y in zip(cut[:-1], cut[1:], strict=True):
                    if x == y:
                        continue
                    if last is not None and g[x] != last:
                        yield out()
                        ids, vs = [], []
                    last = int(g[x])
                    ids.append(i[x:y])
                    vs.append(v[x:y])
            if last is not None:
                yield out()
        return task

    def bundled(df, n, name):
        dealt = df.select(shard_of(n).alias("g"), "vec_id", "v").repartition("g").sortWithinPartitions("g", "vec_id")
        return dealt.mapInArrow(bundle(name), f"{name} int, {name}_ids binary, {name}_vectors binary")

    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    index = bundled(rows, shards, "shard")
    queries = bundled(asked, blocks, "block").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = index.join(queries, "shard").repartition(F.col("shard"), F.col("block"))

    def search(batches):
        tree = held = None
        for b in batches:
            for shard, ids, vs, q_ids, qs in zip(*(b.column(x).to_pylist() for x in (
                    "shard", "shard_ids", "shard_vectors", "block_ids", "block_vectors")), strict=True):
                if held != shard:
                    tree = ProjectedTree(np.frombuffer(ids, "<i8"), np.frombuffer(vs, "<f8").reshape(-1, dims), norm2)
                    held = shard
                q, i, s = [], [], []
                for own, x in zip(np.frombuffer(q_ids, "<i8"), np.frombuffer(qs, "<f8").reshape(-1, dims), strict=True):
                    got, score = tree.search(x, own, k)
                    q.append(np.full(len(got), own))
                    i.append(got)
                    s.append(score)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (q, i, s)],
                                                 ["query_id", "vec_id", "score"])

    found = met.mapInArrow(search, SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
