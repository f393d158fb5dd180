"""Relevance scoring of blocks against a topical corpus (J6, J7, L1-L4) and roll-ups.

Corpus x blocks is a nearest-neighbour problem, solved exactly by pivot cells (``pivot``): a query
searches only the cells that its k-th distance reaches, and no pair rows are emitted. The best cosine
is the nearest neighbour among vectors of length 1.

Everything after the neighbour search (k-distance, reachability, LOF, page and segment
statistics) is plain DataFrame joins and aggregations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.operators import pivot
from trawl.session import ensure_checkpoint_dir

# Rows of corpus vectors broadcast in one piece (and never more bytes than pivot.MAX_BROADCAST_BYTES).
MAX_BROADCAST_VECTORS = 200_000
LOF_EPS = 1e-10
LOF_OFFSET = 1.5


def max_cosine(blocks: DataFrame, corpus: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
               corpus_id_col: str | None = None, corpus_vec_col: str | None = None,
               exclude_self: bool = False, max_broadcast: int = MAX_BROADCAST_VECTORS) -> DataFrame:
    """Best cosine similarity of each block over the corpus, starting at -1.0 (also for blocks
    without a finite, non-zero vector). Returns (id_col, best_sim).

    On vectors of length 1 the best cosine is the nearest neighbour (cosine = 1 - distance^2 / 2)."""

    near = pivot.nearest(pivot.clean(blocks, id_col, vec_col),
                         pivot.clean(corpus, corpus_id_col or id_col, corpus_vec_col or vec_col),
                         1, exclude_self, max_broadcast, directions=True)
    best = near.select(F.col("id").alias(id_col), (1 - F.col("dist") * F.col("dist") / 2).alias("sim"))
    return blocks.select(F.col(id_col).cast("long").alias(id_col)).join(best, id_col, "left").select(
        id_col, F.greatest(F.lit(-1.0), F.coalesce("sim", F.lit(-1.0))).alias("best_sim"))


def cosine_score(blocks: DataFrame, corpus: DataFrame, threshold: float = 0.0, **kw) -> DataFrame:
    """L3: adjusted = best_sim - threshold; prediction 1 iff adjusted >= 0, else -1."""
    s = max_cosine(blocks, corpus, **kw)
    adj = F.col("best_sim") - F.lit(float(threshold))
    return s.withColumn("score", adj).withColumn("pred", F.when(adj >= 0, 1).otherwise(-1))


def knn(queries: DataFrame, corpus: DataFrame, k: int = 8, id_col: str = "vec_id", vec_col: str = "embedding",
        corpus_id_col: str | None = None, corpus_vec_col: str | None = None, exclude_self: bool = False,
        max_broadcast: int = MAX_BROADCAST_VECTORS, report: bool = False) -> DataFrame:
    """K nearest corpus points by Euclidean distance (ties by id), one row per neighbour:
    (id_col, rank, nn_id, dist). With ``report`` also ``cells``: the pivot cells the query searched."""
    near = pivot.nearest(pivot.clean(queries, id_col, vec_col),
                         pivot.clean(corpus, corpus_id_col or id_col, corpus_vec_col or vec_col),
                         k, exclude_self, max_broadcast)
    return near.select(F.col("id").alias(id_col), "rank", "nn_id", "dist", *["cells"] * report)


def _fit_from_neighbours(nn: DataFrame, k: int, id_col: str) -> DataFrame:
    kdist = nn.filter(F.col("rank") == k).select(F.col(id_col).alias("id"), F.col("dist").alias("kdist"))
    reach = nn.join(kdist.withColumnRenamed("id", "nn_id").withColumnRenamed("kdist", "nn_kdist"), "nn_id") \
        .withColumn("reach", F.greatest("dist", "nn_kdist"))
    lrd = reach.groupBy(id_col).agg((F.lit(1.0) / (F.avg("reach") + F.lit(LOF_EPS))).alias("lrd")) \
        .withColumnRenamed(id_col, "id")
    return kdist.join(lrd, "id")


def lof_fit(corpus: DataFrame, k: int = 8, id_col: str = "vec_id", vec_col: str = "embedding",
            max_broadcast: int = MAX_BROADCAST_VECTORS, neighbours: DataFrame | None = None) -> DataFrame:
    """L1 fit: per corpus point its k-distance and local reachability density.
    Returns (id, kdist, lrd). Needs at least k+1 corpus rows."""
    n = corpus.count()
    if n < k + 1:
        raise ValueError(f"LOF needs at least {k + 1} corpus rows, got {n}")
    if neighbours is None:
        # the neighbour lists feed both the k-distances and the reachabilities: computed once
        ensure_checkpoint_dir(corpus.sparkSession)
        neighbours = knn(corpus, corpus, k, id_col, vec_col, exclude_self=True,
                         max_broadcast=max_broadcast).checkpoint(eager=True)
    return _fit_from_neighbours(neighbours, k, id_col)


def lof_score(queries: DataFrame, corpus: DataFrame, model: DataFrame | None = None, k: int = 8,
              threshold: float = 0.0, id_col: str = "vec_id", vec_col: str = "embedding",
              exclude_self: bool = False, max_broadcast: int = MAX_BROADCAST_VECTORS) -> DataFrame:
    """L1 + L2: score = 1.5 - LOF(x); adjusted = score - threshold; pred -1 iff adjusted < 0.
    Returns (id_col, lof, raw_score, score, pred)."""
    ensure_checkpoint_dir(queries.sparkSession)
    # k rows per query, read by the model (leave-one-out) and by the scoring join: materialised
    # once in the checkpoint folder so the neighbour search runs once
    nn = knn(queries, corpus, k, id_col, vec_col, exclude_self=exclude_self,
             max_broadcast=max_broadcast).checkpoint(eager=True)
    if model is None:
        # leave-one-out scoring of the corpus itself: the fit's neighbour lists are the same ones
        same = queries is corpus and exclude_self
        model = lof_fit(corpus, k, id_col, vec_col, max_broadcast, neighbours=nn if same else None)
    m = model.withColumnRenamed("id", "nn_id")
    j = nn.join(m, "nn_id").withColumn("reach", F.greatest("dist", "kdist"))
    agg = j.groupBy(id_col).agg((F.lit(1.0) / (F.avg("reach") + F.lit(LOF_EPS))).alias("lrd_x"),
                                F.avg("lrd").alias("mean_lrd"))
    lof = F.col("mean_lrd") / F.col("lrd_x")
    raw = F.lit(LOF_OFFSET) - lof
    adj = raw - F.lit(float(threshold))
    return agg.select(id_col, lof.alias("lof"), raw.alias("raw_score"),
                      F.coalesce(adj, F.lit(-1.0)).alias("score"),
                      F.when(adj.isNull() | (adj < 0), -1).otherwise(1).alias("pred"))


# ---------------------------------------------------------------- roll-ups

def page_stats(scores: DataFrame, page_col: str = "page", score_col: str = "score", pred_col: str = "pred") -> DataFrame:
    """A1, A3, A4, A6 per page: n blocks, sum, mean, population variance, relevant count/share,
    page relevance (sum of scores of relevant blocks), relevant flag, information sum."""
    s, rel = F.col(score_col), F.col(pred_col) == 1
    agg = scores.groupBy(page_col).agg(
        F.count(F.lit(1)).alias("num_blocks"),
        F.sum(s).alias("score_sum"),
        F.avg(s).alias("score_mean"),
        F.var_pop(s).alias("score_var"),
        F.count_if(rel).alias("num_relevant"),
        F.coalesce(F.sum(F.when(rel, s)), F.lit(0.0)).alias("page_relevance"),
        F.sum(F.greatest(s, F.lit(0.0))).alias("_pos"),
    )
    return agg.select(
        page_col, "num_blocks", "score_sum", "score_mean", "score_var", "num_relevant",
        (F.col("num_relevant") / F.col("num_blocks")).alias("relevant_pct"),
        "page_relevance",
        (F.col("num_relevant") > 0).alias("is_relevant"),
        (F.col("_pos") / F.col("num_blocks")).alias("info_sum"),
    )


def segment_stats(scores: DataFrame, page_col: str = "page", idx_col: str = "block_idx",
                  score_col: str = "score", pred_col: str = "pred", segments: int = 4,
                  page_sizes: DataFrame | None = None) -> DataFrame:
    """A2: ``segments`` segments of floor(n/segments) blocks; the tail belongs to none.
    Pages with 1..segments-1 blocks get ``segments`` rows with sum 0 and NULL mean/var/share."""
    sizes = page_sizes if page_sizes is not None else scores.groupBy(page_col).agg(
        F.count(F.lit(1)).alias("num_blocks"))
    z = F.floor(F.col("num_blocks") / segments)
    j = scores.join(sizes, page_col).withColumn("_z", z)
    seg = j.filter((F.col("_z") > 0) & (F.col(idx_col) < F.col("_z") * segments)) \
        .withColumn("segment", F.floor(F.col(idx_col) / F.col("_z")).cast("int"))
    s = F.col(score_col)
    full = seg.groupBy(page_col, "segment").agg(
        F.sum(s).alias("seg_sum"), F.avg(s).alias("seg_mean"), F.var_pop(s).alias("seg_var"),
        F.avg(F.when(F.col(pred_col) == 1, 1.0).otherwise(0.0)).alias("seg_relevant_pct"))
    small = sizes.filter((F.col("num_blocks") > 0) & (F.col("num_blocks") < segments)) \
        .select(page_col, F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment")) \
        .select(page_col, "segment", F.lit(0.0).alias("seg_sum"), F.lit(None).cast("double").alias("seg_mean"),
                F.lit(None).cast("double").alias("seg_var"), F.lit(None).cast("double").alias("seg_relevant_pct"))
    return full.unionByName(small)


def block_relevance_list(scores: DataFrame, page_col: str = "page", idx_col: str = "block_idx",
                         pred_col: str = "pred") -> DataFrame:
    """A5: per page the relevance flags in block order, as a '0'/'1' string (bounded by page size)."""
    return scores.groupBy(page_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx_col, pred_col))),
                                 lambda x: F.when(x[pred_col] == 1, "1").otherwise("0")), "").alias("relevance_flags"))
