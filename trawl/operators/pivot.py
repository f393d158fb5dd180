"""Exact k-nearest-neighbour search by pivot cells.

A bounded sample of the corpus serves as pivots; every vector belongs to the cell of its nearest pivot.
With a query's distances to the pivots, the triangle inequality bounds from below what a cell can hold:
no nearer than its pivot's distance minus the cell's radius, no nearer than the cell's inner radius minus
the pivot's distance, and no nearer than the plane between its pivot and the query's own. A query searches
its own cell first and then only the cells whose bound reaches its k-th distance so far, so the answer is
that of a search through everything; how many cells that leaves depends on the vectors (all of them
where distances hardly differ).

Two physical forms. A corpus whose bytes are under a bound is broadcast with its cells and each Arrow
batch of queries is searched where it lies. A larger one is dealt to units of at most ``max_rows``
vectors: a cell is cut into rings by distance to its pivot, a ring that is still too large (equal
vectors) by a hash of the id. Queries travel to the units they must visit, in two rounds (own cell,
then what its k-th distance still reaches); a unit that many queries visit is copied per block of
queries, so one task holds one bounded block of each. Neither form emits pairs.

Equal distances go to the smaller id. Null vectors, and those with a null or non-finite component, take
no part: in the corpus they are no neighbours, as queries they get no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.session import ensure_checkpoint_dir

#: Pivots at most (x 64 doubles = 0.5 MB); the square root of the corpus below that.
MAX_PIVOTS = 1024
#: Rings of a cell at most; together at most MAX_PIVOTS x MAX_RINGS rows of statistics.
MAX_RINGS = 64
#: Bytes of vectors that may be broadcast in one piece.
MAX_BROADCAST_BYTES = 100 << 20
#: Queries that a task compares with the pivots at a time.
QUERIES = 1024
#: Rows (with their vectors) that a task hands over at a time.
HANDED = 16384
_CELLS = 1 << 21  # entries of one distance block (16 MB)


def clean(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``v`` of the rows whose vector has only finite components."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("v").isNotNull() & finite)


def scaled(ids: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1; those of length zero or beyond the range are left out."""
    with np.errstate(over="ignore"):
        length = np.sqrt((m ** 2).sum(1))
    use = (length > 0) & np.isfinite(length)
    return ids[use], m[use] / length[use, None]


def _directions(rows: DataFrame) -> DataFrame:
    def scale(batches):
        for pdf in batches:
            ids, m = scaled(pdf["id"].to_numpy(np.int64), matrix(pdf["v"]))
            yield pd.DataFrame({"id": ids, "v": pd.Series(list(m), dtype=object)})

    return rows.mapInPandas(scale, "id long, v array<double>")


def matrix(vectors: pd.Series, dim: int | None = None) -> np.ndarray:
    if not len(vectors):
        return np.zeros((0, dim or 0))
    return np.vstack(vectors.to_list()).astype(np.float64, copy=False)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None, :] - 2.0 * (a @ b.T)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(_squared(a, b), 0.0))


class Found:
    """The nearest rows of a block of queries so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, exclude_self: bool, limit: np.ndarray | None = None):
        self.ids, self.q, self.k, self.exclude_self = ids, q, k, exclude_self
        self.near = np.full((len(ids), k), np.inf)  # squared, in product form, rounded up
        self.limit = np.full(len(ids), np.inf) if limit is None else limit ** 2  # squared, no k-th is beyond
        self.rows, self.hits, self.dist = [], [], []

    def reach(self) -> np.ndarray:
        """Distance up to which a row may still be among the k nearest."""
        return np.sqrt(np.maximum(np.minimum(self.near[:, -1], self.limit), 0.0))

    def look(self, rows: np.ndarray, ids: np.ndarray, m: np.ndarray) -> None:
        """Compares the queries ``rows`` with the corpus vectors ``m``."""
        if not len(rows) or not len(ids):
            return
        step = max(1, _CELLS // len(ids))
        length = (m ** 2).sum(1)
        right = np.column_stack([m, np.ones(len(m)), length]).T
        order = np.argsort(ids, kind="stable") if self.exclude_self else None
        for part in (rows[i:i + step] for i in range(0, len(rows), step)):
            qa = self.q[part]
            own = (qa ** 2).sum(1)
            slack = 1e-9 * (own + length.max())  # rounding of a squared distance in product form
            d2 = np.column_stack([-2.0 * qa, own, np.ones(len(qa))]) @ right  # squared distances in one product
            if self.exclude_self:
                first, last = (np.searchsorted(ids, self.ids[part], side, sorter=order) for side in ("left", "right"))
                for x in np.flatnonzero(last > first):
                    d2[x, order[first[x]:last[x]]] = np.inf
            # most queries have no row of the block within reach; only the others are looked at closely
            upto = np.minimum(self.near[part, -1], self.limit[part]) + slack
            some = np.flatnonzero((d2 <= upto[:, None]).any(1))
            if not len(some):
                continue
            if len(some) < len(part):
                part, qa, slack, d2 = part[some], qa[some], slack[some], d2[some]
            both = np.concatenate([self.near[part], d2 + slack[:, None]], 1)
            self.near[part] = np.sort(np.partition(both, self.k - 1, axis=1)[:, :self.k], axis=1)
            upto = np.minimum(self.near[part, -1], self.limit[part]) + slack
            hit = (d2 <= upto[:, None]) & np.isfinite(d2)
            many = hit.sum(1) > 4 * self.k + 16  # many equal distances: the smallest ids decide at once
            r, c = np.nonzero(hit & ~many[:, None])
            self._keep(part[r], ids[c], np.sqrt(((m[c] - qa[r]) ** 2).sum(1)))
            for x in np.flatnonzero(many):
                c = np.flatnonzero(hit[x])
                exact = np.sqrt(((m[c] - qa[x]) ** 2).sum(1))
                first = np.lexsort((ids[c], exact))[:self.k]
                self._keep(np.full(len(first), part[x]), ids[c[first]], exact[first])

    def _keep(self, rows, ids, dist) -> None:
        self.rows.append(rows)
        self.hits.append(ids)
        self.dist.append(dist)

    def nearest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query row, rank from 0, id, distance) of the k nearest, by query and rank."""
        if not self.rows:
            z = np.zeros(0, np.int64)
            return z, z, z, np.zeros(0)
        rows, ids, dist = (np.concatenate(x) for x in (self.rows, self.hits, self.dist))
        order = np.lexsort((ids, dist, rows))
        rows, ids, dist = rows[order], ids[order], dist[order]
        start = np.searchsorted(rows, rows, "left")
        rank = np.arange(len(rows)) - start
        keep = rank < self.k
        return rows[keep], rank[keep], ids[keep], dist[keep]


class Cells:
    """Pivots and, per ring of a cell, its inner and outer radius and number of rows. ``small`` holds the
    smallest radii of each cell (padded by infinity), for a first bound on a query's k-th distance."""

    def __init__(self, pivots: np.ndarray, cell: np.ndarray, inner: np.ndarray, outer: np.ndarray,
                 count: np.ndarray, small: np.ndarray):
        self.pivots, self.cell, self.inner, self.outer, self.count, self.small = pivots, cell, inner, outer, count, small
        self.between = distances(pivots, pivots)
        self.slack = 1e-6 * (1.0 + np.abs(pivots).max(initial=0.0) * max(1, pivots.shape[1]) ** 0.5)

    def home(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to all pivots and the nearest one."""
        d = distances(q, self.pivots)
        return d, d.argmin(1)

    def first_reach(self, d: np.ndarray, wanted: int) -> np.ndarray:
        """A distance within which each query surely has ``wanted`` rows."""
        out = np.empty(len(d))
        step = max(1, _CELLS // max(1, self.small.size))
        for i in range(0, len(d), step):
            bound = (d[i:i + step, :, None] + self.small[None]).reshape(len(d[i:i + step]), -1)
            out[i:i + step] = np.partition(bound, wanted - 1, axis=1)[:, wanted - 1] if bound.shape[1] >= wanted else np.inf
        return out + self.slack

    def bound(self, d: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Lower bound of the distance to every ring's rows, per query."""
        to, own = d[:, self.cell], d[np.arange(len(d)), home]
        low = np.maximum(to - self.outer[None], self.inner[None] - to)
        gap = self.between[home][:, self.cell]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (to ** 2 - own[:, None] ** 2) / (2 * gap)
        return np.maximum(low, np.where(gap > 0, plane, 0.0)) - self.slack


def choose(ids: np.ndarray, m: np.ndarray, n: int) -> np.ndarray:
    """Pivots: of the given rows those whose ids mix smallest, as many as the square root of ``n``
    (bounded). Equal vectors make one pivot."""
    p = min(MAX_PIVOTS, max(1, int(np.ceil(np.sqrt(n)))))
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(m[np.lexsort((ids, mixed ^ (mixed >> np.uint64(29))))[:p]], axis=0)


# ---------------------------------------------------------------- broadcast form

class Index:
    """A whole corpus in memory, sorted by cell."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, pivots: np.ndarray, wanted: int):
        step = max(1, _CELLS // max(1, len(pivots)))
        d = [distances(m[i:i + step], pivots) for i in range(0, len(m), step)]
        cell = np.concatenate([x.argmin(1) for x in d] or [np.zeros(0, np.int64)])
        r = np.concatenate([x.min(1) for x in d] or [np.zeros(0)])
        order = np.lexsort((r, cell))
        self.ids, self.m, cell, r = ids[order], m[order], cell[order], r[order]
        used, self.start, count = np.unique(cell, return_index=True, return_counts=True)
        self.stop = self.start + count
        small = np.full((len(pivots), wanted), np.inf)
        for c, a, b in zip(used, self.start, np.minimum(self.stop, self.start + wanted), strict=True):
            small[c, :b - a] = r[a:b]
        self.cells = Cells(pivots, used, r[self.start], r[self.stop - 1], count, small)

    def search(self, ids: np.ndarray, q: np.ndarray, k: int, exclude_self: bool):
        """The nearest rows as ``Found.nearest`` gives them, and the cells each query visited."""
        if not len(self.ids):
            return Found(ids, q, k, exclude_self).nearest(), np.zeros(len(ids), np.int64)
        d, home = self.cells.home(q)
        found = Found(ids, q, k, exclude_self, self.cells.first_reach(d, k + exclude_self))
        low = self.cells.bound(d, home)
        visits = np.zeros(len(ids), np.int64)
        own = self.cells.cell[None, :] == home[:, None]
        for mine in (True, False):
            for c, (a, b) in enumerate(zip(self.start, self.stop, strict=True)):
                rows = np.flatnonzero((own[:, c] == mine) & (low[:, c] <= found.reach() + self.cells.slack))
                visits[rows] += 1
                found.look(rows, self.ids[a:b], self.m[a:b])
        return found.nearest(), visits


def _broadcast_search(queries: DataFrame, corpus: DataFrame, n: int, k: int, exclude_self: bool, directions: bool) -> DataFrame:
    def vectors(pdf):
        ids, m = pdf["id"].to_numpy(np.int64), matrix(pdf["v"])
        return scaled(ids, m) if directions else (ids, m)

    ids, m = vectors(corpus.toPandas())  # its bytes are checked by the caller
    index = Index(ids, m, choose(ids, m, n), k + exclude_self)
    shared = queries.sparkSession.sparkContext.broadcast(index)

    def search(batches):
        for whole in batches:
            for i in range(0, len(whole), QUERIES):
                ids, q = vectors(whole.iloc[i:i + QUERIES])
                (row, rank, nn, dist), visits = shared.value.search(ids, q, k, exclude_self)
                yield pd.DataFrame({"id": ids[row], "rank": rank + 1, "nn_id": nn, "dist": dist, "cells": visits[row]})

    # the work is queries x corpus: spread over the cores, however few splits the queries' file has
    spread = queries.repartition(3 * queries.sparkSession.sparkContext.defaultParallelism, "id")
    return spread.mapInPandas(search, "id long, rank int, nn_id long, dist double, cells long")


# ---------------------------------------------------------------- shuffled form

def _located(corpus: DataFrame, pivots: np.ndarray) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast(pivots)

    def locate(batches):
        for whole in batches:
            for i in range(0, len(whole), QUERIES):
                pdf = whole.iloc[i:i + QUERIES]
                d = distances(matrix(pdf["v"]), shared.value)
                yield pdf.assign(cell=d.argmin(1), r=d.min(1))

    return corpus.mapInPandas(locate, "id long, v array<double>, cell int, r double").checkpoint(eager=True)


def _statistics(located: DataFrame, pivots: np.ndarray, wanted: int, max_rows: int) -> tuple[DataFrame, Cells]:
    """The rows with their ring, and the cells' statistics (bounded by pivots x rings)."""
    steps = [i / MAX_RINGS for i in range(1, MAX_RINGS)]
    cuts = located.groupBy("cell").agg(F.count("*").alias("n"), F.percentile_approx("r", steps, 1000).alias("cuts"))
    rings = F.least(F.ceil(F.col("n") / max_rows), F.lit(MAX_RINGS))
    below = F.size(F.filter("cuts", lambda x: x < F.col("r")))
    ringed = located.join(F.broadcast(cuts), "cell").select(
        "id", "v", "cell", "r", F.floor(below * rings / MAX_RINGS).cast("int").alias("ring"))
    stats = ringed.groupBy("cell", "ring").agg(
        F.min("r").alias("inner"), F.max("r").alias("outer"), F.count("*").alias("n")).orderBy("cell", "ring").toPandas()
    first = ringed.withColumn("at", F.row_number().over(Window.partitionBy("cell").orderBy("r", "id"))) \
        .where(F.col("at") <= wanted).select("cell", "at", "r").toPandas()
    small = np.full((len(pivots), wanted), np.inf)
    small[first["cell"], first["at"] - 1] = first["r"]
    cells = Cells(pivots, stats["cell"].to_numpy(), stats["inner"].to_numpy(), stats["outer"].to_numpy(),
                  stats["n"].to_numpy(), small)
    number = corpus_rings(ringed, stats)
    return number, cells


def corpus_rings(ringed: DataFrame, stats: pd.DataFrame) -> DataFrame:
    spark = ringed.sparkSession
    table = spark.createDataFrame(list(zip(stats["cell"].tolist(), stats["ring"].tolist(), range(len(stats)),
                                           stats["n"].tolist(), strict=True)), "cell int, ring int, unit int, n long")
    return ringed.join(F.broadcast(table), ["cell", "ring"]).select("id", "v", "unit", "n")


def _visits(queries: DataFrame, cells: Cells, wanted: int, own: bool) -> DataFrame:
    """One row per query and ring it must search. ``reach`` (null in the first round) is the k-th distance
    found so far."""
    shared = queries.sparkSession.sparkContext.broadcast(cells)

    def visit(batches):
        c = shared.value
        for whole in batches:
            for i in range(0, len(whole), QUERIES):
                pdf = whole.iloc[i:i + QUERIES]
                q = matrix(pdf["v"])
                d, home = c.home(q)
                reach = np.minimum(pdf["reach"].fillna(np.inf).to_numpy(), c.first_reach(d, wanted))
                near = (c.bound(d, home) <= reach[:, None] + c.slack) & ((c.cell[None, :] == home[:, None]) == own)
                all_rows, all_units = np.nonzero(near)
                for at in range(0, len(all_rows), HANDED):  # a query that visits many units is as many vectors
                    row, unit = all_rows[at:at + HANDED], all_units[at:at + HANDED]
                    yield pd.DataFrame({"id": pdf["id"].to_numpy()[row], "v": pdf["v"].to_numpy()[row],
                                        "reach": reach[row], "unit": unit})

    return queries.mapInPandas(visit, "id long, v array<double>, reach double, unit int")


def _searched(visits: DataFrame, rows: DataFrame, k: int, exclude_self: bool, max_rows: int) -> DataFrame:
    """Co-groups of (block of a unit's rows, block of its queries): the k nearest of each."""
    load = visits.groupBy("unit").agg(F.count("*").alias("load"))
    blocks = F.ceil(F.col("load") / max_rows).cast("int")
    parts = F.ceil(F.col("n") / max_rows).cast("int")
    sizes = rows.select("unit", "n").distinct()
    asked = visits.join(load, "unit").join(sizes, "unit").select(
        "id", "v", "reach", "unit", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    held = rows.join(load, "unit").select(
        "id", "v", "unit", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))

    def search(left, right):
        found = Found(left["id"].to_numpy(np.int64), matrix(left["v"]), k, exclude_self, left["reach"].to_numpy())
        found.look(np.arange(len(left)), right["id"].to_numpy(np.int64), matrix(right["v"]))
        row, _, nn, dist = found.nearest()
        return pd.DataFrame({"id": found.ids[row], "nn_id": nn, "dist": dist})

    key = ["unit", "part", "block"]
    return asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(search, "id long, nn_id long, dist double")


def _shuffled_search(queries: DataFrame, corpus: DataFrame, n: int, k: int, exclude_self: bool, max_rows: int) -> DataFrame:
    ensure_checkpoint_dir(queries.sparkSession)
    wanted = k + exclude_self
    some = corpus.orderBy(F.xxhash64("id"), "id").limit(MAX_PIVOTS).toPandas()
    if not len(some):
        return _none(queries)
    pivots = choose(some["id"].to_numpy(np.int64), matrix(some["v"]), n)
    rows, cells = _statistics(_located(corpus, pivots), pivots, wanted, max_rows)
    rank = F.row_number().over(Window.partitionBy("id").orderBy("dist", "nn_id"))

    def best(found):  # at most k rows per query and unit it visited
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    home = _visits(queries.withColumn("reach", F.lit(None).cast("double")), cells, wanted, True).checkpoint(eager=True)
    first = best(_searched(home, rows, k, exclude_self, max_rows)).drop("rank").checkpoint(eager=True)
    # rounding: the k-th distance is reached by rows at that distance too
    reach = first.groupBy("id").agg(F.max("dist").alias("kth"), F.count("*").alias("m")).where(F.col("m") == k)
    again = queries.join(reach.select("id", (F.col("kth") * (1 + 1e-9)).alias("reach")), "id", "left")
    far = _visits(again, cells, wanted, False).checkpoint(eager=True)
    found = best(first.unionByName(_searched(far, rows, k, exclude_self, max_rows)))
    searched = home.select("id").unionByName(far.select("id")).groupBy("id").agg(F.count("*").alias("cells"))
    return found.join(searched, "id").select("id", F.col("rank").cast("int"), "nn_id", "dist", "cells")


def _none(queries: DataFrame) -> DataFrame:
    return queries.where(F.lit(False)).selectExpr("id", "0 as rank", "cast(0 as long) as nn_id", "cast(0 as double) as dist",
                                                  "cast(0 as long) as cells")


def nearest(queries: DataFrame, corpus: DataFrame, k: int, exclude_self: bool, max_broadcast: int,
            max_rows: int = 8192, directions: bool = False) -> DataFrame:
    """id, rank (from 1), nn_id, dist, cells (cells or rings the query searched). ``queries`` and ``corpus``
    have ``id`` (unique among the queries) and ``v`` as ``clean`` gives them; the corpus is broadcast up to
    ``max_broadcast`` rows and MAX_BROADCAST_BYTES bytes. With ``directions`` all vectors are scaled to
    length 1 first, and those that cannot be take no part."""
    n, dim = corpus.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return _none(queries)
    if n <= min(max_broadcast, MAX_BROADCAST_BYTES // (8 * (dim + 1))):
        return _broadcast_search(queries, corpus, n, k, exclude_self, directions)
    if directions:
        queries, corpus = _directions(queries), _directions(corpus)
    return _shuffled_search(queries, corpus, n, k, exclude_self, min(max_rows, max(1, max_broadcast)))
