"""Evaluation queries: harvest_rate (W1/W2), recall_running (W3), target_hits (J9),
stage_time (A7), path_depth (A8, M4), info_sum (A6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import meta as M
from trawl.operators import evaluate as EV
from trawl.operators.parse import extract_links
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.session import configure, load_table


def _labelled_docs(spark, sf_dir):
    configure(spark)
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = load_table(spark, sf_dir, "labels")
    return labels.join(docs, "doc_id").withColumn("url", F.concat(F.lit("doc:"), F.col("doc_id").cast("string")))


@register("harvest_rate", """
WITH d AS (SELECT l.doc_id, l.quality, d.n_chars FROM labels l JOIN documents d USING (doc_id))
SELECT doc_id,
       (sum(quality) OVER w)::BIGINT AS cum_relevant, count(*) OVER w AS cum_total,
       round(sum(quality) OVER w / count(*) OVER w, 6) AS harvest_rate,
       (sum(n_chars) OVER w)::DOUBLE AS cum_time
FROM d WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def q_harvest_rate(spark, sf_dir):
    d = _labelled_docs(spark, sf_dir).withColumn("is_relevant", F.col("quality") == 1)
    e = EV.evaluate(d, ["doc_id"], "is_relevant", time_col="n_chars")
    return e.select("doc_id", F.col("cum_relevant").cast("long").alias("cum_relevant"), "cum_total",
                    F.round("harvest_rate", 6).alias("harvest_rate"), F.round("cum_time", 6).alias("cum_time"))


@register("recall_running", """
WITH t AS (SELECT DISTINCT 'doc:' || doc_id AS url FROM labels WHERE toxic = 1),
d AS (SELECT doc_id, 'doc:' || doc_id AS url FROM documents),
h AS (SELECT d.doc_id, (t.url IS NOT NULL)::INTEGER AS hit FROM d LEFT JOIN t USING (url))
SELECT doc_id, (sum(hit) OVER w)::BIGINT AS cum_hits, round(sum(hit) OVER w / (SELECT count(*) FROM t), 6) AS recall
FROM h WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def q_recall_running(spark, sf_dir):
    configure(spark)
    docs = load_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"), F.lit(False).alias("rel"))
    labels = load_table(spark, sf_dir, "labels")
    targets = labels.filter(F.col("toxic") == 1).select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"))
    e = EV.evaluate(docs, ["doc_id"], "rel", targets=targets)
    return e.select("doc_id", F.col("cum_hits").cast("long").alias("cum_hits"), F.round("recall", 6).alias("recall"))


@register("target_hits", """
WITH t AS (SELECT DISTINCT 'doc:' || doc_id AS url FROM labels WHERE toxic = 1)
SELECT d.doc_id, t.url IS NOT NULL AS is_target FROM documents d LEFT JOIN t ON 'doc:' || d.doc_id = t.url
""")
def q_target_hits(spark, sf_dir):
    configure(spark)
    docs = load_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"))
    labels = load_table(spark, sf_dir, "labels")
    targets = labels.filter(F.col("toxic") == 1).select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"))
    return EV.target_hits(docs, targets).select("doc_id", "is_target")


@register("stage_time", """
SELECT event_id, round(value + (props::JSON->>'k')::DOUBLE + length(event_type) * 1.0 + value * 0.5, 6) AS total_ms
FROM events
""")
def q_stage_time(spark, sf_dir):
    configure(spark)
    ev = load_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    times = F.create_map(F.lit("parse"), k, F.lit("segment"), F.length("event_type").cast("double"),
                         F.lit("embed"), F.col("value") * 0.5)
    return ev.select("event_id", F.round(EV.processing_time(times, F.col("value")), 6).alias("total_ms"))


@register("path_depth", f"""
WITH {Q.links_ctes()},
s AS (SELECT page_id, link_pos, len(list_filter(string_split({Q.path_of('src_url')}, '/'), lambda x: x <> '')) AS parent_depth FROM lk)
SELECT page_id, link_pos, parent_depth::BIGINT AS parent_depth, (parent_depth + 1)::BIGINT AS path_depth, 1::BIGINT AS depth FROM s
""")
def q_path_depth(spark, sf_dir):
    from trawl.functions import urls as U
    configure(spark)
    links = extract_links(load_table(spark, sf_dir, "pages"))
    segs = F.filter(F.split(U.path_of("src_url"), "/"), lambda x: x != "")
    parent_md = F.when(F.size(segs) > 0, F.create_map(F.lit("url.path"), segs)).otherwise(M.empty_md())
    child = M.inherit_md(parent_md, F.col("src_url"))
    return links.select("page_id", F.col("link_pos").cast("long").alias("link_pos"),
                        EV.path_depth(parent_md).alias("parent_depth"), EV.path_depth(child).alias("path_depth"),
                        M.first(child, "depth").cast("long").alias("depth"))
