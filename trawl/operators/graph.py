"""Link graph ranking.

HITS is iterated as DataFrame joins: per round one join of the edges with the previous hub
scores (grouped by target: new authorities) and one with the previous authority scores
(grouped by source: new hubs), both from the *previous* round (Jacobi), then L2 norms per
graph. Many graphs (count windows of 100 pages) are ranked in the same job by carrying a
``graph`` key. Lineage is cut every round with ``checkpoint()`` to the session's checkpoint
directory, so a lost executor recomputes at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.operators.ordered import position_within
from trawl.session import broadcast_if_small, ensure_checkpoint_dir

MAX_BROADCAST_NODES = 5_000_000
#: Bytes of node names up to which the scores are broadcast, through the driver, twice a round.
MAX_BROADCAST_NAMES = 16 << 20


def distinct_edges(edges: DataFrame, src: str = "src", dst: str = "dst", graph_col: str | None = None) -> DataFrame:
    """A10: set semantics per source."""
    cols = ([graph_col] if graph_col else []) + [src, dst]
    return edges.select(*cols).where(F.col(src).isNotNull() & F.col(dst).isNotNull()).distinct()


def hits(edges: DataFrame, rounds: int = 5, src: str = "src", dst: str = "dst", graph_col: str | None = None,
         checkpoint: bool = True, norm_every: int = 8, max_broadcast_nodes: int = MAX_BROADCAST_NODES,
         max_broadcast_names: int = MAX_BROADCAST_NAMES) -> DataFrame:
    """H1: hub and authority scores of every node, per graph.

    Returns (graph?, node, hub, authority). Graphs without edges (zero norm) give no rows.
    """
    spark = edges.sparkSession
    g = [graph_col] if graph_col else []
    e = distinct_edges(edges, src, dst, graph_col)
    if checkpoint:
        ensure_checkpoint_dir(spark)
        e = e.checkpoint(eager=True)
    nodes = e.select(*g, F.col(src).alias("node")).union(e.select(*g, F.col(dst).alias("node"))).distinct()
    n_nodes, names = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col("node").cast("string"))), F.lit(0))).first()
    small = n_nodes <= max_broadcast_nodes and names <= max_broadcast_names
    scores = nodes.select(*g, "node", F.lit(1.0).alias("hub"), F.lit(1.0).alias("authority"))
    e_by_src = e_by_dst = e
    if not small:
        # Scores too large to broadcast: keep two copies of the edges hash-partitioned by source
        # and by target (checkpoint keeps the partitioning), so each round shuffles only the
        # scores and the partial sums, never the edges again.
        n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        e_by_src = e.repartition(n, *g, src)
        e_by_dst = e.repartition(n, *g, dst)
        if checkpoint:
            e_by_src, e_by_dst = e_by_src.checkpoint(eager=True), e_by_dst.checkpoint(eager=True)

    def normalise(raw: DataFrame) -> DataFrame:
        norms = raw.groupBy(*g).agg(F.sqrt(F.sum(F.col("h") * F.col("h"))).alias("nh"),
                                    F.sqrt(F.sum(F.col("a") * F.col("a"))).alias("na"))
        if g:
            norms, _ = broadcast_if_small(norms)  # one row per graph
            j = raw.join(norms, g)
        else:
            nh, na = norms.first() if n_nodes else (0.0, 0.0)  # two scalars
            j = raw.withColumn("nh", F.lit(nh)).withColumn("na", F.lit(na))
        return j.filter((F.col("nh") > 0) & (F.col("na") > 0)).select(
            *g, "node", (F.col("h") / F.col("nh")).alias("hub"), (F.col("a") / F.col("na")).alias("authority"))

    # Every round's L2 normalisation is a positive factor per graph and per vector, so the
    # directions after t rounds do not depend on when it is applied: vectors are normalised
    # every ``norm_every`` rounds (bounding their growth) and at the end, not in a job per round.
    for t in range(1, rounds + 1):
        s = F.broadcast(scores) if small else scores
        auth_in = e_by_src.join(s.select(*g, F.col("node").alias(src), "hub"), [*g, src]) \
            .groupBy(*g, F.col(dst).alias("node")).agg(F.sum("hub").alias("a"))
        hub_in = e_by_dst.join(s.select(*g, F.col("node").alias(dst), "authority"), [*g, dst]) \
            .groupBy(*g, F.col(src).alias("node")).agg(F.sum("authority").alias("h"))
        # every node ends an edge or starts one, so the full outer join of the two sums already
        # holds every node (no join with the node list per round)
        raw = auth_in.join(hub_in, [*g, "node"], "full_outer") \
            .select(*g, "node", F.coalesce("h", F.lit(0.0)).alias("h"), F.coalesce("a", F.lit(0.0)).alias("a"))
        if checkpoint:
            raw = raw.checkpoint(eager=True)  # lineage cut: a lost executor recomputes one round
        if t == rounds or t % norm_every == 0:
            scores = normalise(raw)
        else:
            scores = raw.select(*g, "node", F.col("h").alias("hub"), F.col("a").alias("authority"))
    return scores


def count_windows(pages: DataFrame, order_col: str, size: int = 100, out: str = "graph") -> DataFrame:
    """T5: number pages in arrival order and cut them into windows of ``size`` pages."""
    pos = position_within(pages, [], [order_col], out="_arrival")
    return pos.withColumn(out, F.floor((F.col("_arrival") - 1) / size).cast("long")).drop("_arrival")


def top_k(scores: DataFrame, col: str, k: int = 10, graph_col: str | None = None, digits: int = 9) -> DataFrame:
    """H2: the ``k`` best nodes by ``col`` (rounded to ``digits`` so equal scores tie), ties by node."""
    r = F.round(col, digits)
    if graph_col is None:
        return scores.orderBy(r.desc(), F.col("node")).limit(k).withColumn("rank", F.lit(None).cast("long"))
    from trawl.operators.ordered import top_k_per_key

    return top_k_per_key(scores.withColumn("_r", r), [graph_col], [F.col("_r").desc(), F.col("node")], k,
                         salt_col="node").drop("_r")


def graph_json(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """K7: one JSON line per source: {"src": [sorted distinct targets]}; a source's list is its
    out-degree (bounded by the page's links)."""
    adj = edges.groupBy(src).agg(F.sort_array(F.collect_set(dst)).alias("targets"))
    return adj.select(src, F.to_json(F.create_map(F.col(src), F.col("targets"))).alias("json"))


def read_graph_json(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON adjacency lines back to (src, dst) edges."""
    m = lines.select(F.explode(F.from_json(F.col(col), "map<string,array<string>>")).alias("src", "targets"))
    return m.select("src", F.explode("targets").alias("dst"))
