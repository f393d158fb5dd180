"""Frontier, status table and fetch planning.

The fetcher's in-memory queues are re-aimed as planning queries over a URL table. Every
per-queue order uses the skew-safe helpers of ``trawl.operators.ordered``: one queue (host or
domain) may hold a third of all URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import meta as M
from trawl.operators.ordered import position_within, top_k_per_key
from trawl.session import broadcast_if_small

STATUSES = ("DISCOVERED", "FETCHED", "FETCH_ERROR", "REDIRECTION", "ERROR")


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


# ------------------------------------------------------------------ S1 / T9

def due_urls(frontier: DataFrame, now, max_queues: int = 250, max_per_queue: int = 30,
             lease_s: int = 300, key_col: str = "key") -> DataFrame:
    """URLs due at ``now`` and not leased; at most ``max_per_queue`` per queue (earliest
    first, then URL) from at most ``max_queues`` queues (queues with the earliest due URL
    first). Returns the handed-out rows with ``leased_until = now + lease``.

    Exact top-k per queue with hot queues split (salted candidates), and a dense rank over the
    small per-queue table for the queue limit."""
    now = _c(now)
    due = frontier.filter(F.col("next_fetch").isNotNull() & (F.col("next_fetch") <= now)
                          & (F.coalesce(F.col("leased_until"), F.lit("1970-01-01").cast("timestamp")) <= now))
    top = top_k_per_key(due, [key_col], [F.col("next_fetch"), F.col("url")], max_per_queue, salt_col="url")
    queues = top.groupBy(key_col).agg(F.min("next_fetch").alias("_first"))
    # the queue limit is the feature: a distributed top-n (per-partition top-n, then merge)
    chosen = queues.orderBy("_first", key_col).limit(max_queues).select(key_col)
    out = top.join(F.broadcast(chosen), key_col, "left_semi").drop("rank")  # at most max_queues rows
    return out.withColumn("leased_until", F.timestamp_add("SECOND", F.lit(lease_s), now))


def apply_lease(frontier: DataFrame, handed_out: DataFrame) -> DataFrame:
    """Write the lease of handed-out URLs back into the frontier (left join on url)."""
    lease = handed_out.select("url", F.col("leased_until").alias("_lease"))
    return frontier.join(lease, "url", "left").withColumn(
        "leased_until", F.coalesce(F.col("_lease"), F.col("leased_until"))).drop("_lease")


def frontier_to_pages(frontier: DataFrame, values_col: str = "values") -> Column:
    """Flatten a list of (key, value list) entries into the metadata multi-map."""
    return F.map_from_entries(F.transform(F.col(values_col), lambda e: F.struct(e["key"], e["values"])))


# ------------------------------------------------------------------ K6

def upsert_status(table: DataFrame, updates: DataFrame, order_cols=("ts",)) -> DataFrame:
    """K6: latest update per url wins; DISCOVERED never overwrites an existing row.

    The latest update per url is a partial aggregation (``max_by``), then one full outer join
    on url with the current table."""
    upd = updates.groupBy("url").agg(
        F.max_by(F.struct(*[c for c in updates.columns if c != "url"]), F.struct(*order_cols)).alias("_u"))
    upd = upd.select("url", "_u.*")
    cols = [c for c in table.columns if c != "url"]
    t = table.select("url", *[F.col(c).alias("_t_" + c) for c in cols], F.lit(True).alias("_in_table"))
    j = t.join(upd.select("url", *[F.col(c).alias("_u_" + c) for c in cols], F.lit(True).alias("_in_upd")),
               "url", "full_outer")
    take_update = F.col("_in_upd") & (F.col("_in_table").isNull() | (F.col("_u_status") != "DISCOVERED"))
    return j.select("url", *[F.when(take_update, F.col("_u_" + c)).otherwise(F.col("_t_" + c)).alias(c)
                             for c in cols])


# ------------------------------------------------------------------ R1, R3, R4, R6, K5

def split_status(status: DataFrame, redirect: bool = True):
    """(status branch, log branch). With ``redirect`` DISCOVERED rows go to the log branch."""
    if not redirect:
        return status, status.filter(F.lit(False))
    disc = F.col("status") == "DISCOVERED"
    return status.filter(~disc), status.filter(disc)


def status_from_code(code) -> Column:
    """HTTP code to status (ours: 2xx and 304 FETCHED, 3xx REDIRECTION, 4xx ERROR,
    5xx FETCH_ERROR, anything else ERROR)."""
    c = _c(code)
    return (F.when((c >= 200) & (c < 300), "FETCHED").when(c == 304, "FETCHED")
            .when((c >= 300) & (c < 400), "REDIRECTION").when((c >= 500) & (c < 600), "FETCH_ERROR")
            .otherwise("ERROR"))


def fetch_route(code, allow_redirects: bool = True) -> Column:
    """R3/R7: 'parse' (ok, not 304), 'status' (304 or error), 'status+target' (redirect, when
    redirects are followed) - what happens after a fetch."""
    c = _c(code)
    st = status_from_code(c)
    return (F.when((st == "FETCHED") & (c != 304), "parse")
            .when((st == "REDIRECTION") & F.lit(allow_redirects), "status+target")
            .otherwise("status"))


# Error message buckets, in order.
ERROR_BUCKETS = [("(?i)sockettimeout|read timed out", "Socket timeout fetching"),
                 ("(?i)unknownhost", "Unknown host")]


def error_cause(message) -> Column:
    """Exception text to a cause bucket, else the exception class name."""
    m = _c(message)
    expr = None
    for rx, label in ERROR_BUCKETS:
        expr = F.when(m.rlike(rx), label) if expr is None else expr.when(m.rlike(rx), label)
    cls = F.regexp_extract(m, r"^([A-Za-z0-9_.$]+)", 1)
    return expr.otherwise(F.regexp_extract(cls, r"([A-Za-z0-9_$]+)$", 1))


def error_rows(df: DataFrame, message_col: str, source: str, status: str = "FETCH_ERROR") -> DataFrame:
    """Failures as data rows with error.source / error.cause metadata."""
    md = F.create_map(F.lit("error.source"), F.array(F.lit(source)),
                      F.lit("error.cause"), F.array(error_cause(message_col)))
    return df.withColumn("status", F.lit(status)).withColumn("metadata", md)


def status_log_line(ts, status, next_fetch, url, key, md) -> Column:
    """K5: '%28s %12s %29s %8s %s %s %s' - time, status, next fetch or '-', crawl id, url,
    partition key or '_DEFAULT_', metadata JSON or '-'."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    nf = F.coalesce(F.date_format(_c(next_fetch), iso), F.lit("-"))
    js = F.when(_c(md).isNull() | (F.size(_c(md)) == 0), F.lit("-")).otherwise(M.md_to_json(md))
    return F.format_string("%28s %12s %29s %8s %s %s %s", F.date_format(_c(ts), iso), _c(status), nf,
                           F.lit("DEFAULT"), _c(url), F.coalesce(_c(key), F.lit("_DEFAULT_")), js)


# ------------------------------------------------------------------ F5-F9

def politeness_plan(urls: DataFrame, delays: DataFrame | None = None, key_col: str = "key",
                    order=("url",), default_delay: float = 1.0, min_delay: float = 0.0,
                    threads: int = 1, thread_rules: list[tuple[str, int]] | None = None) -> DataFrame:
    """earliest fetch slot (seconds from the start) of each URL in its queue: position p in
    the queue (skew-safe), slot = floor((p-1)/threads) * delay; with several threads per queue
    the minimum delay applies. Per-queue values come from ``delays(key, delay[, threads])`` and
    from ``thread_rules`` [(queue regex, threads), ...] (first match wins), else the defaults."""
    pos = position_within(urls, [key_col], list(order), out="queue_pos")
    q_threads = F.lit(threads)
    if thread_rules:
        rule = None
        for rx, n in thread_rules:
            rule = F.when(F.col(key_col).rlike(rx), F.lit(n)) if rule is None else rule.when(F.col(key_col).rlike(rx), F.lit(n))
        q_threads = rule.otherwise(q_threads)
    if delays is not None:
        cols = [key_col, F.col("delay").alias("_qd")] + ([F.col("threads").alias("_qt")] if "threads" in delays.columns else [])
        qd, _ = broadcast_if_small(delays.select(*cols))  # one row per queue, size checked
        pos = pos.join(qd, key_col, "left")
        base = F.coalesce(F.col("_qd"), F.lit(default_delay))
        if "threads" in delays.columns:
            q_threads = F.coalesce(F.col("_qt"), q_threads)
    else:
        base = F.lit(default_delay)
    out = pos.withColumn("threads", q_threads.cast("int"))
    out = out.withColumn("delay", F.when(F.col("threads") > 1, F.lit(min_delay)).otherwise(base)).withColumn(
        "slot_s", F.floor((F.col("queue_pos") - 1) / F.col("threads")) * F.col("delay"))
    return out.drop("_qd", "_qt", "threads") if threads == 1 and not thread_rules and (
        delays is None or "threads" not in delays.columns) else out.drop("_qd", "_qt")


def apply_crawl_delay(queues: DataFrame, robots_delay_col: str = "robots_delay", **rule) -> DataFrame:
    """F6 as rows: the queue delay, or (delay beyond the maximum and not forced) an ERROR row
    with cause ``crawl_delay`` for the queue's URLs."""
    from trawl.functions.schedule import crawl_delay

    d = crawl_delay(F.col(robots_delay_col), **rule)
    return queues.withColumn("delay", d) \
        .withColumn("status", F.when(F.col("delay").isNull(), F.lit("ERROR"))) \
        .withColumn("error_cause", F.when(F.col("delay").isNull(), F.lit("crawl_delay")))


def round_robin(planned: DataFrame, key_col: str = "key") -> DataFrame:
    """global hand-out order rotating over queues: by (position in queue, queue)."""
    return position_within(planned, [], ["queue_pos", key_col], out="rr_order")


def queue_caps(urls: DataFrame, key_col: str = "key", cap: int = -1, now=None, timeout_s: int = -1,
               queued_col: str = "queued_at", order=("queued_at", "url")) -> DataFrame:
    """F8: drop items waiting longer than ``timeout_s``; keep at most ``cap`` per queue (first
    queued first). -1 disables either rule. Adds ``kept``."""
    out = urls
    keep = F.lit(True)
    if timeout_s >= 0 and now is not None:
        waited = F.unix_micros(_c(now).cast("timestamp")) - F.unix_micros(F.col(queued_col).cast("timestamp"))
        keep = keep & (waited <= F.lit(int(timeout_s) * 1_000_000))
    out = out.withColumn("_fresh", keep)
    if cap >= 0:
        # position among the fresh items of the queue: ranking on (queue, fresh) needs no self join
        pos = position_within(out, [key_col, "_fresh"], list(order), out="_qpos")
        return pos.withColumn("kept", F.col("_fresh") & (F.col("_qpos") <= cap)).drop("_fresh", "_qpos")
    return out.withColumnRenamed("_fresh", "kept")


def queue_report(urls: DataFrame, key_col: str = "key") -> DataFrame:
    """URLs per queue (count and first/last URL; the URL list itself is not collected)."""
    return urls.groupBy(key_col).agg(F.count(F.lit(1)).alias("n_urls"), F.min("url").alias("first_url"),
                                     F.max("url").alias("last_url"))
