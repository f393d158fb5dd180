"""Connected components by alternating large-star and small-star steps, all in DataFrames. Before each
pair of steps every task contracts the edges it reads to stars (``CHUNK`` at a time), which takes no
shuffle and spares rounds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.store import persist


#: Edges that a task contracts at once.
CHUNK = 500_000


def _contracted(edges: DataFrame) -> DataFrame:
    """Stars (u, v), v the smallest of its star, that join what the edges of a chunk join."""

    def task(batches):
        over: dict[int, int] = {}
        n = 0

        def top(a):
            while (b := over.get(a, a)) != a:
                over[a] = a = over.get(b, b)
            return a

        def stars():
            rows = [(a, r) for a in over if (r := top(a)) != a]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.int64()) for i in (0, 1)], ["u", "v"])

        for b in batches:
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                u, v = top(u), top(v)
                if u != v:
                    over[max(u, v)] = min(u, v)
            n += b.num_rows
            if n >= CHUNK:
                yield stars()
                over.clear()
                n = 0
        yield stars()

    return edges.select("u", "v").mapInArrow(task, "u long, v long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour of a node (larger ones, or those not larger) to the smallest."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        out = both.join(least, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:  # u > v in every edge
        least = both.groupBy("x").agg(F.min("y").alias("m"))
        joined = both.join(least, "x")
        out = joined.where("y > m").select(F.col("y").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return out.where("u != v")


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b long); component is the smallest node.

    A step that has lost its executor is redone from the table of the round before."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    e, was = persist(_contracted(e), "edges"), None
    for _ in range(most_rounds):
        e = persist(_star(_star(_contracted(e), True), False).distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
