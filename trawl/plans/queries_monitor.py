"""Monitoring queries over metric rows derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import schedule as S
from trawl.operators import monitor as MO
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.session import configure, load_table

# Fixed values (ours): metric name per event type.
NAMES = {"view": "fetcher_counter/fetched", "click": "fetcher_average_perdoc/time_in_queues",
         "purchase": "fetcher_average_persec/bytes_fetched_perSec", "error": "fetcher_counter/status_500",
         "signup": "memory/heap/used"}


def metrics(spark, sf_dir):
    configure(spark)
    ev = load_table(spark, sf_dir, "events")
    name = F.create_map(*[x for kv in NAMES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])[F.col("event_type")]
    comp = F.when(F.col("user_id") < 50, "fetch").when(F.col("user_id") < 100, "parse").otherwise("status")
    return ev.select(name.alias("name"), F.col("user_id").alias("task_id"), comp.alias("component"),
                     F.concat(F.lit("worker-"), F.floor(F.col("user_id") / 30).cast("string")).alias("worker"),
                     (F.lit(6700) + F.floor(F.col("user_id") / 30)).cast("int").alias("port"),
                     F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")


def _task_id(spark, sf_dir):
    """``task_id`` as the SQL types it, a SMALLINT; where a table's ids go beyond that, as the table types them."""
    ids = load_table(spark, sf_dir, "events").agg(F.min("user_id"), F.max("user_id")).first()
    narrow = all(x is None or -(1 << 15) <= x < 1 << 15 for x in ids)
    return F.col("task_id").cast("short").alias("task_id") if narrow else F.col("task_id")


NAME_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items()) + " END"
SQL_M = f"""m AS (SELECT {NAME_SQL} AS name, user_id::SMALLINT AS task_id,
       CASE WHEN user_id < 50 THEN 'fetch' WHEN user_id < 100 THEN 'parse' ELSE 'status' END AS component,
       'worker-' || (user_id // 30) AS worker, ts, value, event_type FROM events)"""


def _b(every: str) -> str:
    return Q.fmt_ts(f"time_bucket(INTERVAL '{every}', ts)")


@register("metric_buckets", f"""
WITH {SQL_M}
SELECT {_b('10 seconds')} AS bucket, name, count(*) AS n, round(avg(value), 6) AS mean_value,
       round(sum(value), 6) AS sum_value, round(sum(value) / 10.0, 6) AS per_sec
FROM m GROUP BY ALL
""")
def q_metric_buckets(spark, sf_dir):
    b = MO.metric_buckets(metrics(spark, sf_dir), 10)
    return b.select(S.fmt_ts("bucket").alias("bucket"), "name", "n", *[F.round(c, 6).alias(c) for c in
                                                                     ["mean_value", "sum_value", "per_sec"]])


def _top_sql(name: str, agg: str) -> str:
    return f"""
WITH {SQL_M},
per AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS b, task_id, {agg}(value) AS metric FROM m WHERE name = '{name}' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY metric DESC, task_id) AS rank FROM per)
SELECT {Q.fmt_ts('b')} AS bucket, task_id, round(metric, 6) AS metric, rank FROM r WHERE rank <= 5
"""


@register("top_tasks", _top_sql(NAMES["click"], "avg"))
def q_top_tasks(spark, sf_dir):
    t = MO.top_series(metrics(spark, sf_dir), NAMES["click"], "avg", "1 hour", 5)
    return t.select(S.fmt_ts("bucket").alias("bucket"), _task_id(spark, sf_dir), F.round("metric", 6).alias("metric"),
                    F.col("rank").cast("long").alias("rank"))


@register("top_tasks_sum", _top_sql(NAMES["view"], "sum"))
def q_top_tasks_sum(spark, sf_dir):
    t = MO.top_series(metrics(spark, sf_dir), NAMES["view"], "sum", "1 hour", 5)
    return t.select(S.fmt_ts("bucket").alias("bucket"), _task_id(spark, sf_dir), F.round("metric", 6).alias("metric"),
                    F.col("rank").cast("long").alias("rank"))


@register("rate_series", f"""
WITH {SQL_M}
SELECT {_b('1 hour')} AS bucket, round(avg(value), 6) AS metric FROM m WHERE name = '{NAMES['purchase']}' GROUP BY ALL
""")
def q_rate_series(spark, sf_dir):
    s = MO.series(metrics(spark, sf_dir), NAMES["purchase"], "avg", "1 hour")
    return s.select(S.fmt_ts("bucket").alias("bucket"), F.round("metric", 6).alias("metric"))


@register("bytes_per_minute", f"""
WITH {SQL_M}
SELECT {_b('1 minute')} AS bucket, round(sum(value), 6) AS metric FROM m WHERE name = '{NAMES['purchase']}' GROUP BY ALL
""")
def q_bytes_per_minute(spark, sf_dir):
    s = MO.series(metrics(spark, sf_dir), NAMES["purchase"], "sum", "1 minute")
    return s.select(S.fmt_ts("bucket").alias("bucket"), F.round("metric", 6).alias("metric"))


@register("status_counts", """
SELECT CASE event_type WHEN 'view' THEN 'FETCHED' WHEN 'click' THEN 'DISCOVERED' WHEN 'error' THEN 'FETCH_ERROR'
            WHEN 'purchase' THEN 'REDIRECTION' ELSE 'ERROR' END AS status, count(*) AS n
FROM events GROUP BY 1 ORDER BY n DESC, status LIMIT 5
""")
def q_status_counts(spark, sf_dir):
    from trawl.plans.queries_schedule import status_rows
    return MO.top_terms(status_rows(spark, sf_dir), "status", 5)


@register("top_hosts", """
SELECT 'h' || user_id || '.example.com' AS host, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, host LIMIT 50
""")
def q_top_hosts(spark, sf_dir):
    from trawl.plans.queries_schedule import status_rows
    return MO.top_terms(status_rows(spark, sf_dir), "host", 50)


@register("two_level_top", f"""
WITH {SQL_M},
o AS (SELECT task_id, avg(value) AS outer_avg FROM m GROUP BY task_id ORDER BY outer_avg DESC, task_id LIMIT 10),
i AS (SELECT m.task_id, m.event_type, avg(m.value) AS inner_avg FROM m JOIN o USING (task_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY inner_avg DESC, event_type) AS rank FROM i)
SELECT r.task_id, r.event_type, round(r.inner_avg, 6) AS inner_avg, r.rank, round(o.outer_avg, 6) AS outer_avg
FROM r JOIN o USING (task_id) WHERE rank <= 5
""")
def q_two_level_top(spark, sf_dir):
    t = MO.nested_top(metrics(spark, sf_dir), "task_id", 10, "event_type", 5)
    return t.select(_task_id(spark, sf_dir), "event_type", F.round("inner_avg", 6).alias("inner_avg"),
                    F.col("rank").cast("long").alias("rank"), F.round("outer_avg", 6).alias("outer_avg"))


@register("heap_by_worker", f"""
WITH {SQL_M}, h AS (SELECT * FROM m WHERE starts_with(name, 'memory/heap')),
w AS (SELECT worker FROM h GROUP BY worker ORDER BY avg(value) DESC, worker LIMIT 5),
hw AS (SELECT * FROM h WHERE worker IN (SELECT worker FROM w)),
nm AS (SELECT worker, name FROM (SELECT worker, name, row_number() OVER (PARTITION BY worker ORDER BY avg(value) DESC, name) AS rk
       FROM hw GROUP BY worker, name) WHERE rk <= 10)
SELECT worker, name, {_b('1 day')} AS bucket, round(avg(value), 6) AS metric
FROM hw WHERE (worker, name) IN (SELECT (worker, name) FROM nm) GROUP BY ALL
""")
def q_heap_by_worker(spark, sf_dir):
    h = MO.heap_by_worker(metrics(spark, sf_dir))
    return h.select("worker", "name", S.fmt_ts("bucket").alias("bucket"), F.round("metric", 6).alias("metric"))
