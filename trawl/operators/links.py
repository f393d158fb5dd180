"""Link priority and child status rows.

Inputs are exploded block links ``(page key, url, block_idx, link, block score)`` and page
statistics; the positional zip of the reference (block i <-> score i <-> links i) is an
equi-join on (page, block_idx).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import schedule as S
from trawl.functions import urls as U
from trawl.session import broadcast_if_small


def link_priority(block_links: DataFrame, page_scores: DataFrame, key_cols=("page_id",),
                  block_score_col: str = "block_score", page_rel_col: str = "page_relevance") -> DataFrame:
    """C1 + C2: relevance of each block link and the derived next-fetch date (whole minutes, F1)."""
    j = block_links.join(page_scores.select(*key_cols, page_rel_col), list(key_cols))
    rel = S.link_relevance(F.col(page_rel_col), F.col(block_score_col))
    return j.withColumn("link_relevance", rel) \
        .withColumn("seconds", S.relevance_seconds(rel)) \
        .withColumn("next_fetch", S.truncate_minute(S.relevance_to_date(rel)))


def not_seen(rows: DataFrame, history: DataFrame, url_col: str = "url", hist_col: str = "url") -> DataFrame:
    """Rows whose fragment-free URL is not in ``history`` (left anti join)."""
    h = history.select(U.strip_fragment(hist_col).alias("_seen")).distinct()
    h, _ = broadcast_if_small(h)
    return rows.join(h, U.strip_fragment(url_col) == F.col("_seen"), "left_anti")


def seen(rows: DataFrame, history: DataFrame, url_col: str = "url", hist_col: str = "url") -> DataFrame:
    """J4 complement: rows already crawled (left semi join) - they become FETCHED rows."""
    h = history.select(U.strip_fragment(hist_col).alias("_seen")).distinct()
    h, _ = broadcast_if_small(h)
    return rows.join(h, U.strip_fragment(url_col) == F.col("_seen"), "left_semi")


def mark_seen(rows: DataFrame, history: DataFrame, url_col: str = "url", hist_col: str = "url",
              out_col: str = "seen") -> DataFrame:
    """J4 in one pass: flag each row whose fragment-free URL is in ``history`` (left join on the
    distinct history, broadcast under the checked bound), instead of an anti join and a semi
    join that would each read the rows."""
    h = history.select(U.strip_fragment(hist_col).alias("_seen")).distinct().withColumn("_hit", F.lit(True))
    h, _ = broadcast_if_small(h)
    return rows.join(h, U.strip_fragment(url_col) == F.col("_seen"), "left") \
        .withColumn(out_col, F.coalesce(F.col("_hit"), F.lit(False))).drop("_seen", "_hit")


def child_status(prioritised: DataFrame, crawled: DataFrame, link_col: str = "link", page_url_col: str = "url",
                 key_cols=("page_id",), fetched_pages: DataFrame | None = None) -> DataFrame:
    """One DISCOVERED row per target (not the page itself, not crawled; earliest date when a
    target occurs in several blocks), then one FETCHED row per page without a date."""
    links = prioritised.filter(F.col(link_col) != F.col(page_url_col))
    links = not_seen(links, crawled, link_col, "url")
    disc = links.groupBy(F.col(link_col).alias("url")).agg(F.min("next_fetch").alias("next_fetch")) \
        .select("url", F.lit("DISCOVERED").alias("status"), "next_fetch")
    src = fetched_pages if fetched_pages is not None else prioritised
    fetched = src.select(F.col(page_url_col).alias("url")).distinct() \
        .select("url", F.lit("FETCHED").alias("status"), F.lit(None).cast("timestamp").alias("next_fetch"))
    return disc.unionByName(fetched)


def tunnelling(md_depth: Column, relevant: Column) -> Column:
    """C4 (inactive in the reference): irrelevant blocks lower maxLinkDepth by one; -1 stops."""
    return F.when(relevant, md_depth).otherwise(md_depth - 1)


def segment_rule(num_blocks: Column, relevant_pct: Column, segments: Column, min_blocks: int = 4,
                 min_share: float = 0.0, seg_share: float = 0.333) -> Column:
    """C5 (inactive in the reference): relevant if the share and block count pass, or any
    segment share exceeds ``seg_share`` with enough blocks."""
    return ((relevant_pct > min_share) & (num_blocks >= min_blocks)) | (
        (num_blocks >= min_blocks) & F.exists(segments, lambda s: s["seg_relevant_pct"] > seg_share))
