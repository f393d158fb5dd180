"""Entry 1 as a batch job: one focused-crawl step over a table of fetched pages.

frontier (S1 due URLs) -> fetched pages -> redirects (P9, P10: such a page is not parsed further; its
target is DISCOVERED) -> content blocks (B1-B4) -> embeddings (E3) -> block scores
against the topical corpus (J6/L3 or J7/L1) -> page statistics (A1-A4) -> link priority (C1, C2)
-> normalised and filtered links (U6-U8) -> child status rows (C3, J4) + FETCHED and REDIRECTION rows
-> focused schedule (F1) -> status upsert (K6)
-> next frontier.

Stage boundaries are joins on the URL; the corpus is broadcast after a size check; block
embeddings are computed per Arrow batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import meta as M
from trawl.functions import urls as U
from trawl.operators import blocks as B
from trawl.operators import embed as E
from trawl.operators import frontier as FR
from trawl.operators import links as L
from trawl.operators import relevance as R
from trawl.operators.parse import redirects
from trawl.session import ensure_checkpoint_dir


def score_blocks(blocks: DataFrame, corpus: DataFrame, scorer: str = "cosine", threshold: float = 0.0,
                 model_fn=None, dims: int = 64) -> DataFrame:
    """Blocks with ``block_id``, ``score`` (adjusted) and ``pred``."""
    b = blocks.withColumn("block_id", F.xxhash64("url", "block_idx"))
    emb = E.embed(b.select("block_id", "text"), model_fn, dims=dims)
    if scorer == "cosine":
        s = R.cosine_score(emb, corpus, threshold=threshold, id_col="block_id", corpus_id_col="vec_id")
    else:
        s = R.lof_score(emb, corpus, threshold=threshold, id_col="block_id")
    return b.join(s.select("block_id", "score", "pred"), "block_id")


def crawl_step(pages: DataFrame, frontier: DataFrame, corpus: DataFrame, now: Column, scorer: str = "cosine",
               threshold: float = 0.0, model_fn=None, key_mode: str = "host") -> DataFrame:
    """Returns the next frontier ``(url, key, metadata, status, next_fetch, leased_until)``."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    # ``due`` and the block scores are read by several consumers (fetch join, lease, page
    # statistics, link priority): they are materialised once to the checkpoint folder instead
    # of being recomputed per consumer, and their lineage is cut there.
    due = FR.due_urls(frontier, now).checkpoint(eager=True)
    pages_n = U.materialize(pages.withColumnRenamed("url", "_raw_url"), "url", U.normalise("_raw_url"))
    fetched = pages_n.join(due.select("url"), "url", "left_semi")
    # a page that names another address (not its own with a fragment) is a redirect: its target is
    # discovered, its content not read
    moved = redirects(fetched).where("status = 'REDIRECTION'").select("page_id", "url", "status", U.normalise("redir_to").alias("target"))
    moved = moved.where(~F.col("target").eqNullSafe(F.col("url"))).checkpoint(eager=True)
    targets = moved.select(F.col("target").alias("url")).where(U.chain(U.basic_filter("url"), U.regex_filter("url")))
    stay = fetched.join(moved.select("page_id"), "page_id", "left_anti")
    blocks = B.segment_pages(stay, min_words=B.MIN_WORDS).where("is_content")
    scored = score_blocks(blocks, corpus, scorer, threshold, model_fn).checkpoint(eager=True)
    stats = R.page_stats(scored, page_col="url")
    bl = scored.select("page_id", "url", "block_idx", F.col("score").alias("block_score"),
                       F.posexplode("links").alias("link_idx", "link"))
    bl = U.materialize(bl.withColumnRenamed("link", "_raw"), "link", U.normalise("_raw")).where(
        U.chain(U.basic_filter("link"), U.regex_filter("link")))
    prio = L.link_priority(bl, stats.select("url", "page_relevance"), key_cols=("url",))
    crawled = frontier.filter(F.col("status") == "FETCHED").select("url").unionByName(fetched.select("url"))
    child = L.child_status(prio, crawled, link_col="link", page_url_col="url", key_cols=("url",), fetched_pages=stay)
    none = F.lit(None).cast("timestamp").alias("next_fetch")
    child = child.unionByName(moved.select("url", "status", none)).unionByName(
        L.not_seen(targets, crawled, "url", "url").distinct().select("url", F.lit("DISCOVERED").alias("status"), now.alias("next_fetch")))
    updates = child.select(
        "url", U.partition_key("url", key_mode).alias("key"),
        M.empty_md().alias("metadata"), "status", "next_fetch", F.lit(None).cast("timestamp").alias("leased_until"),
        now.alias("ts"))
    table = FR.apply_lease(frontier, due)
    return FR.upsert_status(table, updates, order_cols=("ts",)).select(*frontier.columns)


def seed_frontier(urls: DataFrame, now: Column, key_mode: str = "host") -> DataFrame:
    """DISCOVERED rows due at ``now`` for a list of URLs (S3 seeds)."""
    return urls.select(U.normalise("url").alias("url")).filter(F.col("url").isNotNull()).distinct().select(
        "url", U.partition_key("url", key_mode).alias("key"), M.empty_md().alias("metadata"),
        F.lit("DISCOVERED").alias("status"), now.alias("next_fetch"), F.lit(None).cast("timestamp").alias("leased_until"))
