"""Embedding queries over ``documents``: tfidf (E4), pad_mask (E1 over whole texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.operators import embed as E
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.session import configure, load_table


def _docs(spark, sf_dir):
    configure(spark)
    return load_table(spark, sf_dir, "documents")


def _bucket_sql(term: str, n: int) -> str:
    return f"((('0x' || substr(md5({term}), 1, 8))::BIGINT) % {n})"


TOKENS_SQL = f"regexp_extract_all(lower(text), {Q.lit(E.TOKEN_RE)}, 0)"


@register("tfidf", f"""
WITH t AS (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(DISTINCT doc_id) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf * ln((n.n + 1.0) / (df.df + 1.0)) AS w FROM tf JOIN df USING (term), n)
SELECT doc_id, {_bucket_sql('term', 64)} AS dim, round(sum(w), 6) AS weight FROM w GROUP BY doc_id, dim
""")
def q_tfidf(spark, sf_dir):
    t = E.tfidf(_docs(spark, sf_dir), dims=64)
    return t.select("doc_id", F.col("dim").cast("long").alias("dim"), F.round("weight", 6).alias("weight"))


@register("pad_mask", f"""
WITH ids AS (SELECT doc_id, list_transform({TOKENS_SQL}, lambda t: {_bucket_sql('t', E.VOCAB - 1)} + 1) AS ids
             FROM documents),
w AS (SELECT doc_id, ids, unnest(generate_series(0, greatest(ceil(len(ids) / {E.WINDOW}), 1)::BIGINT - 1)) AS window_idx FROM ids),
s AS (SELECT doc_id, window_idx, list_resize(list_slice(ids, window_idx * {E.WINDOW} + 1, (window_idx + 1) * {E.WINDOW}), {E.WINDOW}, 0) AS input_ids FROM w)
SELECT doc_id, window_idx, len(list_filter(input_ids, lambda x: x <> 0))::BIGINT AS n_real,
       list_sum(input_ids)::BIGINT AS id_sum, input_ids[1] AS first_id, input_ids[{E.WINDOW}] AS last_id
FROM s
""")
def q_pad_mask(spark, sf_dir):
    p = E.pad_windows(_docs(spark, sf_dir))
    return p.select("doc_id", F.col("window_idx").cast("long").alias("window_idx"),
                    F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_real"),
                    F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"),
                    F.col("input_ids")[0].alias("first_id"), F.col("input_ids")[E.WINDOW - 1].alias("last_id"))
