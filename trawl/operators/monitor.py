"""Crawl metrics and dashboard queries.

Metric rows are ``metrics(name, task_id, component, worker, port, ts, value)``. Buckets are
tumbling windows; top-k per bucket uses the salted exact top-k so a bucket or task holding a
third of the rows is still split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.operators.ordered import top_k_per_key


def bucket(ts_col: str, every: str, df: DataFrame | None = None) -> F.Column:
    """Tumbling bucket start; a TIMESTAMP column is used as is so a streaming watermark on it applies."""
    c = F.col(ts_col)
    if df is None or dict(df.dtypes).get(ts_col) != "timestamp":
        c = c.cast("timestamp")
    return F.window(c, every)


def metric_buckets(metrics: DataFrame, seconds: int = 10, ts_col: str = "ts") -> DataFrame:
    """Per bucket and metric name: count, mean per document, sum and per-second rate."""
    b = bucket(ts_col, f"{seconds} seconds", metrics)
    # grouped on the window struct itself, so a watermark on ``ts`` closes buckets in a stream
    agg = metrics.groupBy(b.alias("_w"), "name").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"), F.sum("value").alias("sum_value"),
        (F.sum("value") / F.lit(float(seconds))).alias("per_sec"))
    return agg.select(F.col("_w.start").alias("bucket"), "name", "n", "mean_value", "sum_value", "per_sec")


def top_series(metrics: DataFrame, name: str, agg: str = "avg", every: str = "1 hour", k: int = 5,
               by: str = "task_id", ts_col: str = "ts") -> DataFrame:
    """Q1-Q4: per bucket the ``k`` series (tasks) with the largest avg/sum of metric ``name``."""
    f = F.avg("value") if agg == "avg" else F.sum("value")
    per = metrics.filter(F.col("name") == name).groupBy(bucket(ts_col, every).start.alias("bucket"), by).agg(f.alias("metric"))
    return top_k_per_key(per, ["bucket"], [F.col("metric").desc(), F.col(by)], k, salt_col=by)


def series(metrics: DataFrame, name: str, agg: str = "avg", every: str = "1 hour", ts_col: str = "ts") -> DataFrame:
    """Q5-Q7: one value per bucket over time."""
    f = F.avg("value") if agg == "avg" else F.sum("value")
    return metrics.filter(F.col("name") == name).groupBy(bucket(ts_col, every).start.alias("bucket")).agg(f.alias("metric"))


def top_terms(df: DataFrame, col: str, k: int) -> DataFrame:
    """Q8/Q9: the ``k`` most frequent values (ties by value); a distributed top-n."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(col)).limit(k)


def nested_top(metrics: DataFrame, outer: str, k_outer: int, inner: str, k_inner: int,
               value: str = "value") -> DataFrame:
    """Q10: top ``k_outer`` values of ``outer`` by average, then inside each the top ``k_inner``
    values of ``inner`` by average."""
    o = metrics.groupBy(outer).agg(F.avg(value).alias("outer_avg")).orderBy(
        F.col("outer_avg").desc(), F.col(outer)).limit(k_outer)
    inner_avg = metrics.join(F.broadcast(o.select(outer)), outer, "left_semi") \
        .groupBy(outer, inner).agg(F.avg(value).alias("inner_avg"))
    t = top_k_per_key(inner_avg, [outer], [F.col("inner_avg").desc(), F.col(inner)], k_inner, salt_col=inner)
    return t.join(F.broadcast(o), outer)  # k_outer rows


def heap_by_worker(metrics: DataFrame, prefix: str = "memory/heap", k_workers: int = 5, k_names: int = 10,
                   every: str = "1 day", ts_col: str = "ts") -> DataFrame:
    """Q11: metrics whose name starts with ``prefix``: top workers by average, inside each the
    top names, averaged per time bucket."""
    m = metrics.filter(F.col("name").startswith(prefix))
    w = m.groupBy("worker").agg(F.avg("value").alias("w_avg")).orderBy(F.col("w_avg").desc(), "worker").limit(k_workers)
    mw = m.join(F.broadcast(w.select("worker")), "worker", "left_semi")
    names = mw.groupBy("worker", "name").agg(F.avg("value").alias("n_avg"))
    top_names = top_k_per_key(names, ["worker"], [F.col("n_avg").desc(), F.col("name")], k_names, salt_col="name")
    sel = mw.join(top_names.select("worker", "name"), ["worker", "name"], "left_semi")
    return sel.groupBy("worker", "name", bucket(ts_col, every).start.alias("bucket")).agg(F.avg("value").alias("metric"))
