"""Flagship job: "what to crawl next, and when".

pages -> links (P2) -> resolve (U3) -> normalise (U7, includes U1) -> filter chain (U6, U8,
U10, U11, deny anti-join U12) -> link priority (C1/C2) -> focused schedule (F1) -> one
DISCOVERED row per target URL with its earliest next-fetch date and the number of linking pages.

Plan shape: parsing is a projection + explode (no shuffle); the only exchange is the final
aggregation on the target URL, which is partially aggregated map-side (min / count), so a
target linked from a third of all pages costs one small partial row per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import schedule as S
from trawl.functions import urls as U
from trawl.operators.parse import extract_links
from trawl.operators.urlfilter import filter_chain


def filter_links(links: DataFrame, epsilon: float = 1.0, deny: DataFrame | None = None,
                 target_col: str = "target", source_md: Column | None = None) -> DataFrame:
    """Normalise then apply the chain; returns the links with the normalised ``url``."""
    return filter_chain(links, target_col=target_col, epsilon=epsilon, source_md=source_md, denylist=deny)


def crawl_next(pages: DataFrame, relevance: Column | None = None, epsilon: float = 1.0,
               deny: DataFrame | None = None) -> DataFrame:
    links = extract_links(pages)
    kept = filter_links(links, epsilon=epsilon, deny=deny)
    rel = relevance if relevance is not None else F.lit(0.0)
    dated = kept.withColumn("next_fetch", S.truncate_minute(S.relevance_to_date(rel)))
    per_url = dated.groupBy("url").agg(
        F.min("next_fetch").alias("next_fetch"),
        F.count_distinct("page_id").alias("n_sources"),
    )
    return per_url.select(
        "url",
        U.host("url").alias("host"),
        F.lit("DISCOVERED").alias("status"),
        S.fmt_ts("next_fetch").alias("next_fetch"),
        "n_sources",
    )
