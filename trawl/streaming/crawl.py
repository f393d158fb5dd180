"""Structured Streaming forms.

* ``first_seen_stream`` (T2): first arrival of a normalised URL wins, for good or (with an expiry)
  for a span from its first sight.
* ``known_urls_stream`` (T3): the known-URL cache with idle expiry, a timer per URL that each arrival
  sets anew; ``known_urls`` is its batch form.
* ``metric_stream`` (T6): 10 s tumbling buckets with a watermark, append mode.
* ``crawl_loop`` (T7, T8, T1, K6): micro-batches of arriving page files drive the crawl step;
  each batch writes a new version of the status table (idempotent per batch id).
* ``evaluation_loop`` (T4): running harvest rate / recall across micro-batches; the state is
  four totals, the per-row running values are computed distributed inside each batch.
* ``hits_window_loop`` (T5): pages numbered in arrival order, complete windows of 100 pages
  ranked with HITS as soon as they fill up.

Every sink below is either a versioned table or a file sink, so a replayed batch rewrites the
same output; checkpoints and the small loop state (one JSON line per finished batch) go to the
caller's checkpoint location through the cluster's Hadoop file system.
"""

from __future__ import annotations

import json
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions import urls as U
from trawl.operators import frontier as FR
from trawl.operators.evaluate import target_hits
from trawl.operators.graph import hits
from trawl.operators.monitor import metric_buckets
from trawl.operators.ordered import running_sums
from trawl.operators.parse import extract_links
from trawl.plans.crawl_next import crawl_next


def first_seen_stream(stream: DataFrame, url_col: str = "url", ts_col: str | None = None,
                      expiry: str | None = None) -> DataFrame:
    """Keep the first arrival of each fragment-free URL (T1: the state is keyed by it)."""
    s = stream.withColumn("norm_url", U.strip_fragment(url_col))
    if ts_col and expiry:
        return s.withWatermark(ts_col, expiry).dropDuplicatesWithinWatermark(["norm_url"])
    return s.dropDuplicates(["norm_url"])


def known_urls(rows: DataFrame, idle: str, url_col: str = "url", ts_col: str = "ts") -> DataFrame:
    """T3 (batch): one row (norm_url, ts) for each arrival of a URL that was not known: its first, or one at
    least ``idle`` after the arrival before. Arrivals of a URL merge into sessions before the shuffle."""
    norm = U.strip_fragment(url_col)
    span = f"{pd.Timedelta(idle).value // 1000 - 1} microseconds"  # sessions that touch are one
    return rows.where(norm.isNotNull()).groupBy(norm.alias("norm_url"), F.session_window(ts_col, span).alias("w")).agg(
        F.min(ts_col).alias("ts")).select("norm_url", "ts")


def known_urls_stream(stream: DataFrame, idle: str, url_col: str = "url", ts_col: str = "ts",
                      delay: str = "10 minutes") -> DataFrame:
    """The known-URL cache with idle expiry. Every arrival gives (norm_url, ts, known); a URL is known
    while less than ``idle`` has passed since its last arrival, each arrival starts that span again, and a
    URL whose span has ended (by the watermark, ``delay`` behind the newest arrival) leaves the state.
    Arrivals behind the watermark are dropped."""
    span = pd.Timedelta(idle)
    seen = stream.select(U.strip_fragment(url_col).alias("norm_url"), F.col(ts_col).cast("timestamp").alias("ts")) \
        .where("norm_url is not null and ts is not null").withWatermark("ts", delay)

    def arrivals(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        times = pd.concat([b["ts"] for b in batches]).sort_values(ignore_index=True)  # of one URL and batch
        last = pd.Timestamp(state.get[0], unit="us", tz=times.dt.tz) if state.exists else pd.NaT
        before = times.cummax().shift(1)
        before = before.where(before.notna() & ~(before < last), last) if last is not pd.NaT else before
        known = (before.notna() & (times < before + span)).to_numpy()
        newest = times.iloc[-1] if last is pd.NaT else max(last, times.iloc[-1])
        state.update((int(newest.value // 1000),))
        state.setTimeoutTimestamp(max(int((newest + span).value // 1_000_000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"norm_url": key[0], "ts": times, "known": known})

    return seen.groupBy("norm_url").applyInPandasWithState(
        arrivals, "norm_url string, ts timestamp, known boolean", "last long", "append", "EventTimeTimeout")


def metric_stream(metrics: DataFrame, seconds: int = 10, delay: str = "1 minute", ts_col: str = "ts") -> DataFrame:
    """Tumbling metric buckets; rows later than the watermark are dropped (our bound)."""
    return metric_buckets(metrics.withWatermark(ts_col, delay), seconds, ts_col)


def _fs(spark: SparkSession, path: str):
    """Hadoop file system of ``path`` (local, HDFS, object store: whatever the cluster names)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _committed_dirs(spark: SparkSession, base: str, prefix: str) -> list[tuple[int, str]]:
    """(number, path) of the sub-folders ``prefix<number>`` of ``base`` that hold a _SUCCESS marker."""
    fs, jbase = _fs(spark, base)
    if not fs.exists(jbase):
        return []
    out = []
    for st in fs.listStatus(jbase):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            path = f"{base.rstrip('/')}/{name}"
            if _fs(spark, path + "/_SUCCESS")[0].exists(_fs(spark, path + "/_SUCCESS")[1]):
                out.append((int(name[len(prefix):]), path))
    return sorted(out)


def _latest_version(spark: SparkSession, base: str) -> str | None:
    v = _committed_dirs(spark, base, "v=")
    return v[-1][1] if v else None


def _read_state(spark: SparkSession, state_dir: str, default: dict) -> dict:
    """Small loop state (a few numbers) stored as one JSON line per finished batch."""
    done = _committed_dirs(spark, state_dir, "batch=")
    if not done:
        return dict(default)
    return json.loads(spark.read.text(done[-1][1]).first().value)


def _write_state(spark: SparkSession, state_dir: str, batch_id: int, state: dict) -> None:
    spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{state_dir.rstrip('/')}/batch={batch_id}")


def crawl_loop(spark: SparkSession, pages_dir: str, status_dir: str, checkpoint: str, pages_schema,
               max_files: int = 1, available_now: bool = True, epsilon: float = 1.0):
    """Each micro-batch of page files is parsed into DISCOVERED rows (crawl_next) and
    upserted into the status table; T7: ``maxFilesPerTrigger`` bounds a batch."""
    stream = spark.readStream.schema(pages_schema).option("maxFilesPerTrigger", max_files).parquet(pages_dir)

    def step(batch: DataFrame, batch_id: int):
        found = crawl_next(batch, epsilon=epsilon).select(
            "url", F.col("host").alias("key"), "status", F.col("next_fetch").cast("timestamp").alias("next_fetch"),
            F.lit(batch_id).cast("long").alias("batch"))
        prev = _latest_version(batch.sparkSession, status_dir)
        if prev is None:
            table = found.filter(F.lit(False))  # empty table with the status schema
        else:
            table = batch.sparkSession.read.parquet(prev)
        new = FR.upsert_status(table, found, order_cols=("batch",))
        new.write.mode("overwrite").parquet(os.path.join(status_dir, f"v={batch_id}"))

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def read_status(spark: SparkSession, status_dir: str) -> DataFrame:
    return spark.read.parquet(_latest_version(spark, status_dir))


def evaluation_loop(spark: SparkSession, pages_dir: str, out_dir: str, checkpoint: str, pages_schema,
                    order: list[str], relevant_col: str, targets: DataFrame | None = None, n_targets: int | None = None,
                    max_files: int = 1):
    """T4: running harvest rate and recall over arriving pages (arrival = batch, then ``order``)."""
    stream = spark.readStream.schema(pages_schema).option("maxFilesPerTrigger", max_files).parquet(pages_dir)
    state_dir = f"{checkpoint.rstrip('/')}/eval_totals"

    def step(batch: DataFrame, batch_id: int):
        tot = _read_state(spark, state_dir, {"batch": -1, "rel": 0.0, "n": 0.0, "hits": 0.0})
        if tot["batch"] >= batch_id:  # replay of a finished batch: totals already include it
            return
        df = batch.withColumn("_rel", F.col(relevant_col).cast("double")).withColumn("_one", F.lit(1.0))
        vals = ["_rel", "_one"]
        if targets is not None:
            df = target_hits(df, targets).withColumn("_hit", F.col("is_target").cast("double"))
            vals.append("_hit")
        r = running_sums(df, order, vals).cache()
        out = r.select(*batch.columns, (F.col("cum__rel") + tot["rel"]).alias("cum_relevant"),
                       (F.col("cum__one") + tot["n"]).alias("cum_total"),
                       ((F.col("cum__rel") + tot["rel"]) / (F.col("cum__one") + tot["n"])).alias("harvest_rate"),
                       *([((F.col("cum__hit") + tot["hits"]) / F.lit(float(n_targets))).alias("recall")]
                         if targets is not None and n_targets else []))
        out.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))
        sums = df.agg(*[F.sum(v).alias(v) for v in vals]).first()
        r.unpersist()
        tot = {"batch": batch_id, "rel": tot["rel"] + (sums["_rel"] or 0.0), "n": tot["n"] + (sums["_one"] or 0.0),
               "hits": tot["hits"] + ((sums["_hit"] or 0.0) if targets is not None else 0.0)}
        _write_state(spark, state_dir, batch_id, tot)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def hits_window_loop(spark: SparkSession, pages_dir: str, edges_dir: str, scores_dir: str, checkpoint: str,
                     pages_schema, window: int = 100, rounds: int = 5, max_files: int = 1):
    """T5: page links accumulate with their arrival number; every complete window of ``window``
    pages is ranked once (the last, partial window waits for more pages)."""
    stream = spark.readStream.schema(pages_schema).option("maxFilesPerTrigger", max_files).parquet(pages_dir)
    state_dir = f"{checkpoint.rstrip('/')}/hits_state"

    def step(batch: DataFrame, batch_id: int):
        st = _read_state(spark, state_dir, {"batch": -1, "pages": 0, "ranked": 0})
        if st["batch"] >= batch_id:
            return
        from trawl.operators.ordered import position_within
        numbered = position_within(batch.select("page_id", "url", "html"), [], ["page_id"], out="_arr") \
            .withColumn("arrival", F.col("_arr") + st["pages"]).drop("_arr")
        links = extract_links(numbered.select("page_id", "url", "html")).join(
            numbered.select("page_id", "arrival"), "page_id")
        links.select(F.floor((F.col("arrival") - 1) / window).cast("long").alias("graph"),
                     F.col("src_url").alias("src"), F.col("target").alias("dst")) \
            .write.mode("overwrite").parquet(os.path.join(edges_dir, f"batch={batch_id}"))
        n_pages = st["pages"] + batch.count()
        complete = n_pages // window
        if complete > st["ranked"]:
            e = spark.read.parquet(edges_dir).filter((F.col("graph") >= st["ranked"]) & (F.col("graph") < complete))
            hits(e.select("graph", "src", "dst"), rounds=rounds, graph_col="graph") \
                .write.mode("overwrite").parquet(os.path.join(scores_dir, f"upto={complete}"))
        st = {"batch": batch_id, "pages": n_pages, "ranked": max(st["ranked"], complete)}
        _write_state(spark, state_dir, batch_id, st)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
