"""Crawl evaluation.

Running totals follow the arrival order without a global single-partition window: the
order is range-partitioned, each partition accumulates locally and adds the totals of the
partitions before it (``trawl.operators.ordered.running_sums``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.operators.ordered import running_sums
from trawl.session import broadcast_if_small


def target_hits(pages: DataFrame, targets: DataFrame, url_col: str = "url", target_col: str = "url") -> DataFrame:
    """Flag pages whose URL is in the target list (left join on the distinct list)."""
    t = targets.select(F.col(target_col).alias("_t")).distinct().withColumn("_hit", F.lit(True))
    t, _ = broadcast_if_small(t)
    return pages.join(t, F.col(url_col) == F.col("_t"), "left").withColumn(
        "is_target", F.coalesce(F.col("_hit"), F.lit(False))).drop("_t", "_hit")


def evaluate(pages: DataFrame, order: list[str], relevant_col: str = "is_relevant", time_col: str | None = None,
             targets: DataFrame | None = None, url_col: str = "url", target_col: str = "url") -> DataFrame:
    """Running relevant count, total, harvest rate, processing time and target recall
    (hits so far / target list size; NULL for an empty list)."""
    df = pages.withColumn("_rel", F.col(relevant_col).cast("double")).withColumn("_one", F.lit(1.0))
    values = ["_rel", "_one"]
    if time_col:
        df = df.withColumn("_time", F.col(time_col).cast("double"))
        values.append("_time")
    n_targets = None
    if targets is not None:
        df = target_hits(df, targets, url_col, target_col).withColumn("_hit", F.col("is_target").cast("double"))
        values.append("_hit")
        n_targets = targets.select(target_col).distinct().count()  # one scalar
    r = running_sums(df, order, values)
    out = r.withColumn("cum_relevant", F.col("cum__rel").cast("long")) \
        .withColumn("cum_total", F.col("cum__one").cast("long")) \
        .withColumn("harvest_rate", F.col("cum__rel") / F.col("cum__one"))
    if time_col:
        out = out.withColumn("cum_time", F.col("cum__time"))
    if targets is not None:
        out = out.withColumn("cum_hits", F.col("cum__hit").cast("long")).withColumn(
            "recall", F.try_divide(F.col("cum__hit"), F.lit(float(n_targets)) if n_targets else F.lit(None)))
    return out.drop(*[c for c in out.columns if c.startswith("cum__")], "_rel", "_one", "_time", "_hit")


def processing_time(times: Column, fetch: Column | None = None) -> Column:
    """Fetch time plus all stage times of the map."""
    total = F.aggregate(F.map_values(times), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return total + (fetch.cast("double") if fetch is not None else F.lit(0.0))


def path_depth(md: Column) -> Column:
    """Length of url.path, 0 if missing (size(NULL) is guarded)."""
    return F.coalesce(F.size(F.element_at(md, F.lit("url.path"))), F.lit(0)).cast("long")
