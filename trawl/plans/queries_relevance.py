"""Relevance queries over ``embeddings``: every vector is a block (page = label, block_idx =
position of vec_id inside its label) scored against the whole table as corpus, leaving the
block itself out (J6, J7, L1-L4, A1-A6, E2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.operators import relevance as R
from trawl.operators.ordered import position_within
from trawl.plans.catalog import register
from trawl.session import configure, load_table

K = 8
LOF_THRESHOLD = 0.499  # mid-range of the provided vectors: both signs occur
COS_THRESHOLD = 0.37


def _emb(spark, sf_dir):
    configure(spark)
    return load_table(spark, sf_dir, "embeddings")


def embedding_blocks(emb):
    """Blocks view of the vectors: page = label, block_idx = 0-based position of vec_id in its label."""
    return position_within(emb.select("vec_id", "label"), ["label"], ["vec_id"], out="pos") \
        .select("vec_id", F.col("label").alias("page"), (F.col("pos") - 1).alias("block_idx"))


def lof_scores(spark, sf_dir, threshold=LOF_THRESHOLD):
    emb = _emb(spark, sf_dir)
    return R.lof_score(emb, emb, k=K, threshold=threshold, exclude_self=True)


def scored_blocks(spark, sf_dir):
    """Scored blocks, materialised once: page and segment statistics read them several times."""
    from trawl.session import ensure_checkpoint_dir
    emb = _emb(spark, sf_dir)
    s = R.lof_score(emb, emb, k=K, threshold=LOF_THRESHOLD, exclude_self=True)
    ensure_checkpoint_dir(spark)
    return embedding_blocks(emb).join(s, "vec_id").checkpoint(eager=True)


SQL_E = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
SQL_KNN = f"""{SQL_E},
d AS (SELECT a.vec_id AS q, b.vec_id AS c, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id),
knn AS (SELECT * FROM (SELECT q, c, dist, row_number() OVER (PARTITION BY q ORDER BY dist, c) AS rk FROM d) WHERE rk <= {K})"""
SQL_LOF = f"""{SQL_KNN},
kd AS (SELECT q AS id, dist AS kdist FROM knn WHERE rk = {K}),
lrd AS (SELECT knn.q AS id, 1.0 / (avg(greatest(knn.dist, kd.kdist)) + 1e-10) AS lrd FROM knn JOIN kd ON knn.c = kd.id GROUP BY knn.q),
lofq AS (SELECT knn.q AS vec_id, avg(greatest(knn.dist, kd.kdist)) AS mreach, avg(l.lrd) AS mean_lrd
         FROM knn JOIN kd ON knn.c = kd.id JOIN lrd l ON knn.c = l.id GROUP BY knn.q),
lof AS (SELECT vec_id, mean_lrd / (1.0 / (mreach + 1e-10)) AS lof FROM lofq),
sc AS (SELECT vec_id, lof, 1.5 - lof AS raw_score, 1.5 - lof - {LOF_THRESHOLD} AS score,
              CASE WHEN 1.5 - lof - {LOF_THRESHOLD} < 0 THEN -1 ELSE 1 END AS pred FROM lof),
blk AS (SELECT vec_id, label AS page, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS block_idx FROM e),
sb AS (SELECT blk.*, sc.score, sc.pred FROM blk JOIN sc USING (vec_id))"""


@register("cosine_max", f"""
WITH {SQL_E},
s AS (SELECT a.vec_id, max(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)))) AS m
      FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY a.vec_id)
SELECT vec_id, round(greatest(-1.0, m), 6) AS best_sim, round(greatest(-1.0, m) - {COS_THRESHOLD}, 6) AS score,
       CASE WHEN greatest(-1.0, m) - {COS_THRESHOLD} >= 0 THEN 1 ELSE -1 END AS pred
FROM s
""")
def q_cosine_max(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    s = R.cosine_score(emb, emb, threshold=COS_THRESHOLD, exclude_self=True)
    return s.select("vec_id", F.round("best_sim", 6).alias("best_sim"), F.round("score", 6).alias("score"), "pred")


@register("knn", f"""
WITH {SQL_KNN}
SELECT q AS vec_id, rk AS rank, c AS nn_id, round(dist, 6) AS dist FROM knn
""")
def q_knn(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    n = R.knn(emb, emb, k=K, exclude_self=True)
    return n.select("vec_id", F.col("rank").cast("long").alias("rank"), "nn_id", F.round("dist", 6).alias("dist"))


@register("lof", f"""
WITH {SQL_LOF}
SELECT vec_id, round(lof, 6) AS lof, round(score, 6) AS score, pred FROM sc
""")
def q_lof(spark, sf_dir):
    s = lof_scores(spark, sf_dir)
    return s.select("vec_id", F.round("lof", 6).alias("lof"), F.round("score", 6).alias("score"), "pred")


@register("page_stats", f"""
WITH {SQL_LOF}
SELECT page, count(*) AS num_blocks, round(sum(score), 6) AS score_sum, round(avg(score), 6) AS score_mean,
       round(var_pop(score), 6) AS score_var, count(*) FILTER (WHERE pred = 1) AS num_relevant,
       round(count(*) FILTER (WHERE pred = 1) / count(*), 6) AS relevant_pct,
       round(coalesce(sum(score) FILTER (WHERE pred = 1), 0.0), 6) AS page_relevance,
       count(*) FILTER (WHERE pred = 1) > 0 AS is_relevant,
       round(sum(greatest(score, 0.0)) / count(*), 6) AS info_sum
FROM sb GROUP BY page
""")
def q_page_stats(spark, sf_dir):
    st = R.page_stats(scored_blocks(spark, sf_dir))
    r = {c: F.round(c, 6).alias(c) for c in ["score_sum", "score_mean", "score_var", "relevant_pct",
                                              "page_relevance", "info_sum"]}
    return st.select("page", "num_blocks", r["score_sum"], r["score_mean"], r["score_var"], "num_relevant",
                     r["relevant_pct"], r["page_relevance"], "is_relevant", r["info_sum"])


@register("segment_stats", f"""
WITH {SQL_LOF},
sz AS (SELECT page, count(*) AS n, floor(count(*) / 4) AS z FROM sb GROUP BY page),
seg AS (SELECT sb.page, floor(sb.block_idx / sz.z)::INTEGER AS segment, sb.score, sb.pred
        FROM sb JOIN sz USING (page) WHERE sz.z > 0 AND sb.block_idx < sz.z * 4),
full_seg AS (SELECT page, segment, round(sum(score), 6) AS seg_sum, round(avg(score), 6) AS seg_mean,
                    round(var_pop(score), 6) AS seg_var,
                    round(avg(CASE WHEN pred = 1 THEN 1.0 ELSE 0.0 END), 6) AS seg_relevant_pct
             FROM seg GROUP BY page, segment),
small AS (SELECT page, unnest(range(0, 4))::INTEGER AS segment FROM sz WHERE n > 0 AND n < 4)
SELECT * FROM full_seg
UNION ALL SELECT page, segment, 0.0, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE FROM small
""")
def q_segment_stats(spark, sf_dir):
    st = R.segment_stats(scored_blocks(spark, sf_dir))
    return st.select("page", "segment", *[F.round(c, 6).alias(c) for c in
                                          ["seg_sum", "seg_mean", "seg_var", "seg_relevant_pct"]])


@register("page_relevance", f"""
WITH {SQL_LOF}
SELECT page, block_idx, vec_id, round(score, 6) AS score, pred,
       count(*) FILTER (WHERE pred = 1) OVER (PARTITION BY page) AS page_relevant_blocks
FROM sb
""")
def q_page_relevance(spark, sf_dir):
    sb = scored_blocks(spark, sf_dir)
    per_page = sb.groupBy("page").agg(F.count_if(F.col("pred") == 1).alias("page_relevant_blocks"))
    return sb.join(per_page, "page").select("page", "block_idx", "vec_id", F.round("score", 6).alias("score"),
                                            "pred", "page_relevant_blocks")


@register("mean_pool", f"""
WITH {SQL_E},
u AS (SELECT label, unnest(v) AS x, unnest(generate_series(0, len(v) - 1)) AS dim FROM e)
SELECT label, dim, round(avg(x), 6) AS mean_value FROM u GROUP BY label, dim
""")
def q_mean_pool(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    from trawl.operators.embed import mean_pool
    m = mean_pool(emb, key_cols=["label"])
    return m.select("label", F.col("dim").cast("long").alias("dim"), F.round("mean_value", 6).alias("mean_value"))


@register("page_scores_whole", f"""
WITH {SQL_E},
u AS (SELECT label, unnest(v) AS x, unnest(generate_series(1, len(v))) AS dim FROM e),
pv AS (SELECT label, list(avg_x ORDER BY dim) AS v FROM (SELECT label, dim, avg(x) AS avg_x FROM u GROUP BY label, dim) GROUP BY label),
d AS (SELECT p.label, e.vec_id AS c, list_distance(p.v, e.v) AS dist FROM pv p, e),
pk AS (SELECT * FROM (SELECT label, c, dist, row_number() OVER (PARTITION BY label ORDER BY dist, c) AS rk FROM d) WHERE rk <= {K}),
d2 AS (SELECT a.vec_id AS q, b.vec_id AS c, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id),
knn AS (SELECT * FROM (SELECT q, c, dist, row_number() OVER (PARTITION BY q ORDER BY dist, c) AS rk FROM d2) WHERE rk <= {K}),
kd AS (SELECT q AS id, dist AS kdist FROM knn WHERE rk = {K}),
lrd AS (SELECT knn.q AS id, 1.0 / (avg(greatest(knn.dist, kd.kdist)) + 1e-10) AS lrd FROM knn JOIN kd ON knn.c = kd.id GROUP BY knn.q),
s AS (SELECT pk.label, avg(greatest(pk.dist, kd.kdist)) AS mreach, avg(l.lrd) AS mean_lrd
      FROM pk JOIN kd ON pk.c = kd.id JOIN lrd l ON pk.c = l.id GROUP BY pk.label)
SELECT label AS page, round(1.5 - mean_lrd * (mreach + 1e-10), 6) AS page_score FROM s
""")
def q_page_scores_whole(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    from trawl.operators.embed import mean_pool_vectors
    pv = mean_pool_vectors(emb, key_cols=["label"]).withColumnRenamed("label", "page_key")
    pv = pv.select(F.col("page_key").cast("long").alias("vec_id"), F.col("vector").alias("embedding"))
    model = R.lof_fit(emb, k=K)
    s = R.lof_score(pv, emb, model=model, k=K)
    return s.select(F.col("vec_id").cast("int").alias("page"), F.round("raw_score", 6).alias("page_score"))


@register("segment_rule", f"""
WITH {SQL_LOF},
ps AS (SELECT page, count(*) AS num_blocks, count(*) FILTER (WHERE pred = 1) / count(*) AS relevant_pct FROM sb GROUP BY page),
sz AS (SELECT page, floor(count(*) / 4) AS z FROM sb GROUP BY page),
seg AS (SELECT sb.page, floor(sb.block_idx / sz.z) AS segment, avg(CASE WHEN pred = 1 THEN 1.0 ELSE 0.0 END) AS pct
        FROM sb JOIN sz USING (page) WHERE sz.z > 0 AND sb.block_idx < sz.z * 4 GROUP BY ALL),
mx AS (SELECT page, bool_or(pct > 0.6) AS any_seg FROM seg GROUP BY page)
SELECT ps.page, ((ps.relevant_pct > 0.5 AND ps.num_blocks >= 4) OR (ps.num_blocks >= 4 AND coalesce(mx.any_seg, false))) AS relevant
FROM ps LEFT JOIN mx USING (page)
""")
def q_segment_rule(spark, sf_dir):
    """C5 (inactive in the reference, available here): page decision from the share and the
    segment shares (thresholds 0.5 / 0.6 so both outcomes occur on the provided vectors)."""
    from trawl.operators.links import segment_rule
    sb = scored_blocks(spark, sf_dir)
    ps = R.page_stats(sb)
    seg = R.segment_stats(sb).groupBy("page").agg(F.collect_list(F.struct("segment", "seg_relevant_pct")).alias("segs"))
    j = ps.join(seg, "page", "left").withColumn("segs", F.coalesce("segs", F.array().cast(
        "array<struct<segment:int,seg_relevant_pct:double>>")))
    return j.select("page", segment_rule(F.col("num_blocks"), F.col("relevant_pct"), F.col("segs"), min_blocks=4,
                                         min_share=0.5, seg_share=0.6).alias("relevant"))


@register("info_sum", f"""
WITH {SQL_LOF}
SELECT page, round(sum(greatest(score, 0.0)) / count(*), 6) AS info_sum, count(*) AS num_blocks FROM sb GROUP BY page
""")
def q_info_sum(spark, sf_dir):
    """Sum of the positive block scores over the number of all blocks of the page."""
    st = R.page_stats(scored_blocks(spark, sf_dir))
    return st.select("page", F.round("info_sum", 6).alias("info_sum"), "num_blocks")
