"""Scheduling, status and frontier queries.

Status rows are derived from ``events`` (every row): the user is the host, the value the
page, the event type the status, ``props.k`` the quality flags. Link priority and child
status rows come from the block links of ``pages``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import meta as M
from trawl.functions import schedule as S
from trawl.functions import urls as U
from trawl.operators import blocks as B
from trawl.operators import frontier as FR
from trawl.operators import links as L
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.plans.queries_blocks import blocks_sql
from trawl.session import configure, load_table

NOW = "2024-02-01 00:00:00"
CUT = "2024-01-16 00:00:00"
PULL_NOW = "2024-01-20 00:00:00"
WEIGHTS = {"isCurlieDomain": 0.0, "isWikipediaWeblinkDomain": -0.5, "isClueWebDomain": 0.3}
DATE_KEY = "status.store.as.is.with.nextfetchdate"


def status_rows(spark, sf_dir):
    """(event_id, ts, url, host, status, code, k, metadata) for every event."""
    configure(spark)
    ev = load_table(spark, sf_dir, "events")
    url = F.concat(F.lit("http://h"), F.col("user_id").cast("string"), F.lit(".example.com/p/"),
                   F.floor("value").cast("long").cast("string"))
    et = F.col("event_type")
    status = (F.when(et == "view", "FETCHED").when(et == "click", "DISCOVERED").when(et == "error", "FETCH_ERROR")
              .when(et == "purchase", "REDIRECTION").otherwise("ERROR"))
    code = (F.when(et == "view", 200).when(et == "click", 304).when(et == "purchase", 301)
            .when(et == "error", 503).otherwise(404))
    k = F.get_json_object("props", "$.k").cast("int")
    base = ev.select("event_id", "ts", url.alias("url"), status.alias("status"), code.alias("code"), k.alias("k"))
    md = F.map_concat(
        F.create_map(F.lit("isCurlieDomain"), F.array(F.when(F.col("k") >= 50, "true").otherwise("false"))),
        F.when(F.col("k") < 30, F.create_map(F.lit("isWikipediaWeblinkDomain"), F.array(F.lit("true"))))
        .otherwise(M.empty_md()),
        F.when((F.col("k") >= 20) & (F.col("k") <= 70), F.create_map(F.lit("isClueWebDomain"), F.array(F.lit("true"))))
        .otherwise(M.empty_md()),
        F.create_map(F.lit(DATE_KEY), F.array(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))),
    )
    return base.withColumn("host", U.host("url")).withColumn("metadata", md)


SQL_SV = """sv AS (
  SELECT event_id, ts,
         'http://h' || user_id || '.example.com/p/' || CAST(floor(value) AS BIGINT) AS url,
         'h' || user_id || '.example.com' AS host,
         CASE event_type WHEN 'view' THEN 'FETCHED' WHEN 'click' THEN 'DISCOVERED' WHEN 'error' THEN 'FETCH_ERROR'
              WHEN 'purchase' THEN 'REDIRECTION' ELSE 'ERROR' END AS status,
         CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 304 WHEN 'purchase' THEN 301
              WHEN 'error' THEN 503 ELSE 404 END AS code,
         (props::JSON->>'k')::INTEGER AS k
  FROM events)"""


def _share_sql(weights=WEIGHTS) -> str:
    # flags present and not 'false': curlie is always present ('true'/'false'); the others only when 'true'
    w = weights
    s = (f"(CASE WHEN k >= 50 THEN {float(w['isCurlieDomain'])} ELSE 0.0 END"
         f" + CASE WHEN k < 30 THEN {float(w['isWikipediaWeblinkDomain'])} ELSE 0.0 END"
         f" + CASE WHEN k >= 20 AND k <= 70 THEN {float(w['isClueWebDomain'])} ELSE 0.0 END)")
    return f"greatest(least({s}, 1.0), -1.0)"


def _delay_sql(base: str) -> str:
    return (f"(CASE WHEN {base} = -1 THEN -1 ELSE greatest(trunc(({base})::DOUBLE + {_share_sql()} * -1.0 * "
            f"({base})::DOUBLE)::INTEGER, 0) END)")


def _plus(ts: str, minutes: str) -> str:
    return f"({ts} + to_minutes(({minutes})::BIGINT))"


@register("schedule_focused", f"""
WITH {SQL_SV}
SELECT event_id, url, status,
       {Q.fmt_ts(f'''CASE status WHEN 'FETCHED' THEN NULL WHEN 'DISCOVERED' THEN date_trunc('minute', ts)
            WHEN 'FETCH_ERROR' THEN {_plus(f"TIMESTAMP '{NOW}'", '120')}
            WHEN 'ERROR' THEN {_plus(f"TIMESTAMP '{NOW}'", '44640')}
            WHEN 'REDIRECTION' THEN {_plus(f"TIMESTAMP '{NOW}'", '1440')} END''')} AS next_fetch
FROM sv
""")
def q_schedule_focused(spark, sf_dir):
    sv = status_rows(spark, sf_dir)
    nf = S.schedule_focused(F.col("status"), F.col("metadata"), F.lit(NOW).cast("timestamp"))
    return sv.select("event_id", "url", "status", S.fmt_ts(nf).alias("next_fetch"))


@register("schedule_score", f"""
WITH {SQL_SV}
SELECT event_id, url, status,
       {Q.fmt_ts(f'''CASE status WHEN 'FETCHED' THEN {_plus(f"TIMESTAMP '{NOW}'", _delay_sql('1440'))}
            WHEN 'FETCH_ERROR' THEN {_plus(f"TIMESTAMP '{NOW}'", '120')}
            WHEN 'ERROR' THEN {_plus(f"TIMESTAMP '{NOW}'", '44640')}
            WHEN 'REDIRECTION' THEN {_plus(f"TIMESTAMP '{NOW}'", '1440')}
            ELSE TIMESTAMP '{NOW}' END''')} AS next_fetch
FROM sv
""")
def q_schedule_score(spark, sf_dir):
    sv = status_rows(spark, sf_dir)
    nf = S.schedule_score(F.col("status"), F.col("metadata"), F.lit(NOW).cast("timestamp"), WEIGHTS)
    return sv.select("event_id", "url", "status", S.fmt_ts(nf).alias("next_fetch"))


@register("quality_delay", f"""
WITH {SQL_SV}, b AS (SELECT *, CASE WHEN status = 'FETCH_ERROR' THEN -1 ELSE CAST(floor(k * 30) AS INTEGER) END AS base FROM sv)
SELECT event_id, base, {_delay_sql('base')} AS minutes FROM b
""")
def q_quality_delay(spark, sf_dir):
    sv = status_rows(spark, sf_dir)
    base = F.when(F.col("status") == "FETCH_ERROR", F.lit(-1)).otherwise(F.floor(F.col("k") * 30).cast("int"))
    b = sv.withColumn("base", base)
    return b.select("event_id", "base", S.quality_delay(F.col("metadata"), F.col("base"), WEIGHTS).alias("minutes"))


@register("schedule_adaptive", f"""
WITH {SQL_SV},
r AS (SELECT *, md5(status || ':' || k) AS sig,
             row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) AS rk FROM sv),
l AS (SELECT * FROM r WHERE rk = 1), p AS (SELECT url, sig AS sig_old FROM r WHERE rk = 2),
a AS (SELECT l.*, p.sig_old,
             least(greatest(CASE WHEN p.sig_old IS NULL THEN 1440 WHEN l.sig = p.sig_old THEN 2880 ELSE 720 END, 60), 44640) AS base
      FROM l LEFT JOIN p USING (url))
SELECT url, base::INTEGER AS base, {_delay_sql('base')} AS minutes,
       {Q.fmt_ts(_plus(f"TIMESTAMP '{NOW}'", _delay_sql('base')))} AS next_fetch
FROM a
""")
def q_schedule_adaptive(spark, sf_dir):
    from trawl.operators.ordered import top_k_per_key
    sv = status_rows(spark, sf_dir).withColumn(
        "sig", F.md5(F.concat(F.col("status"), F.lit(":"), F.col("k").cast("string"))))
    top2 = top_k_per_key(sv, ["url"], [F.col("ts").desc(), F.col("event_id").desc()], 2, salt_col="event_id")
    latest = top2.filter(F.col("rank") == 1)
    prev = top2.filter(F.col("rank") == 2).select("url", F.col("sig").alias("sig_old"))
    a = latest.join(prev, "url", "left").withColumn(
        "base", S.adaptive_interval(F.col("sig"), F.col("sig_old"), F.lit(1440)).cast("int"))
    m = S.quality_delay(F.col("metadata"), F.col("base"), WEIGHTS)
    return a.select("url", "base", m.alias("minutes"),
                    S.fmt_ts(S.schedule_adaptive(F.col("metadata"), F.lit(NOW).cast("timestamp"), F.col("base"),
                                                 WEIGHTS)).alias("next_fetch"))


# ------------------------------------------------------------------ link priority

def _prioritised(spark, sf_dir):
    """Block links with the page relevance (content share) computed on the page's block array
    and carried into the same explode: one segmentation pass, no join."""
    configure(spark)
    pages = load_table(spark, sf_dir, "pages")
    arr = B.block_arrays(pages, min_words=0)
    n = F.size("_blocks")
    share = F.when(n > 0, F.size(F.filter("_blocks", lambda b: b["is_content"])) / n).otherwise(F.lit(0.0))
    ex = arr.select("page_id", "url", share.alias("page_relevance"), F.posexplode("_blocks").alias("block_idx", "b"))
    links = F.filter(F.transform("b.hrefs", lambda h: U.strip_fragment(U.resolve(F.col("url"), h))),
                     lambda x: x.isNotNull() & (x != ""))
    bl = ex.select("page_id", "url", F.col("block_idx").cast("long").alias("block_idx"), "page_relevance",
                   F.when(F.col("b.is_content"), 0.5).otherwise(-0.5).alias("block_score"),
                   F.posexplode(links).alias("link_idx", "link"))
    rel = S.link_relevance(F.col("page_relevance"), F.col("block_score"))
    return bl.withColumn("link_relevance", rel).withColumn("seconds", S.relevance_seconds(rel)) \
        .withColumn("next_fetch", S.truncate_minute(S.relevance_to_date(rel)))


SQL_LP = f"""{blocks_sql(0)},
pr AS (SELECT page_id, count(*) FILTER (WHERE is_content) / count(*) AS page_relevance FROM blk GROUP BY page_id),
bl_u AS (SELECT page_id, block_idx, url, is_content, unnest(regexp_extract_all(raw, {Q.A_HREF_RE}, 1)) AS href,
                unnest(generate_series(1, len(regexp_extract_all(raw, {Q.A_HREF_RE}, 1)))) AS pos FROM blk),
bl_r AS (SELECT page_id, block_idx, url, is_content, pos, {Q.strip_fragment(Q.resolve('url', 'href'))} AS link FROM bl_u),
bl_k AS (SELECT *, row_number() OVER (PARTITION BY page_id, block_idx ORDER BY pos) - 1 AS link_idx
         FROM bl_r WHERE link IS NOT NULL AND link <> ''),
lp AS (SELECT bl_k.*, pr.page_relevance,
              pr.page_relevance * 0.3 + CASE WHEN is_content THEN 0.5 ELSE -0.5 END AS rel FROM bl_k JOIN pr USING (page_id)),
lpd AS (SELECT *, {Q.relevance_seconds('rel')} AS seconds,
               date_trunc('minute', {Q.ts_from_seconds(Q.relevance_seconds('rel'))}) AS next_fetch FROM lp)"""


@register("link_priority", f"""
WITH {SQL_LP}
SELECT page_id, block_idx, link_idx, link, round(rel, 6) AS link_relevance, seconds, {Q.fmt_ts('next_fetch')} AS next_fetch
FROM lpd
""")
def q_link_priority(spark, sf_dir):
    p = _prioritised(spark, sf_dir)
    return p.select("page_id", "block_idx", F.col("link_idx").cast("long").alias("link_idx"), "link",
                    F.round("link_relevance", 6).alias("link_relevance"), "seconds",
                    S.fmt_ts("next_fetch").alias("next_fetch"))


@register("child_status", f"""
WITH {SQL_LP},
crawled AS (SELECT DISTINCT {Q.strip_fragment('url')} AS u FROM pages),
d AS (SELECT link AS url, min(next_fetch) AS nf FROM lpd
      WHERE link <> url AND {Q.strip_fragment('link')} NOT IN (SELECT u FROM crawled) GROUP BY link)
SELECT url, 'DISCOVERED' AS status, {Q.fmt_ts('nf')} AS next_fetch FROM d
UNION ALL
SELECT DISTINCT url, 'FETCHED' AS status, NULL::VARCHAR AS next_fetch FROM lpd
""")
def q_child_status(spark, sf_dir):
    p = _prioritised(spark, sf_dir)
    pages = load_table(spark, sf_dir, "pages")
    c = L.child_status(p, pages)
    return c.select("url", "status", S.fmt_ts("next_fetch").alias("next_fetch"))


# ------------------------------------------------------------------ status table, frontier

def _sv_sql_latest(where: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) AS rk FROM sv WHERE {where}) WHERE rk = 1)"


SQL_UPSERT = f"""{SQL_SV},
old AS {_sv_sql_latest(f"ts < TIMESTAMP '{CUT}'")},
upd AS {_sv_sql_latest(f"ts >= TIMESTAMP '{CUT}'")},
ups AS (SELECT coalesce(o.url, u.url) AS url,
               CASE WHEN u.url IS NOT NULL AND (o.url IS NULL OR u.status <> 'DISCOVERED') THEN u.status ELSE o.status END AS status,
               CASE WHEN u.url IS NOT NULL AND (o.url IS NULL OR u.status <> 'DISCOVERED') THEN u.event_id ELSE o.event_id END AS event_id,
               CASE WHEN u.url IS NOT NULL AND (o.url IS NULL OR u.status <> 'DISCOVERED') THEN u.ts ELSE o.ts END AS ts,
               CASE WHEN u.url IS NOT NULL AND (o.url IS NULL OR u.status <> 'DISCOVERED') THEN u.k ELSE o.k END AS k
        FROM old o FULL OUTER JOIN upd u ON o.url = u.url)"""


def _upserted(spark, sf_dir):
    sv = status_rows(spark, sf_dir).select("url", "status", "event_id", "ts", "k", "metadata", "host")
    cut = F.lit(CUT).cast("timestamp")
    old_rows = sv.filter(F.col("ts") < cut)
    table = old_rows.groupBy("url").agg(F.max_by(F.struct("status", "event_id", "ts", "k", "metadata", "host"),
                                                 F.struct("ts", "event_id")).alias("r")).select("url", "r.*")
    return FR.upsert_status(table, sv.filter(F.col("ts") >= cut), order_cols=("ts", "event_id"))


@register("status_upsert", f"""
WITH {SQL_UPSERT}
SELECT url, status, event_id FROM ups
""")
def q_status_upsert(spark, sf_dir):
    return _upserted(spark, sf_dir).select("url", "status", "event_id")


@register("frontier_pull", f"""
WITH {SQL_UPSERT},
fr AS (SELECT url, 'h' || regexp_extract(url, 'http://h([0-9]+)', 1) || '.example.com' AS key,
              CASE status WHEN 'FETCHED' THEN {_plus('ts', _delay_sql('1440'))} WHEN 'FETCH_ERROR' THEN {_plus('ts', '120')}
                   WHEN 'ERROR' THEN {_plus('ts', '44640')} WHEN 'REDIRECTION' THEN {_plus('ts', '1440')} ELSE ts END AS next_fetch
       FROM ups),
due AS (SELECT * FROM fr WHERE next_fetch IS NOT NULL AND next_fetch <= TIMESTAMP '{PULL_NOW}'),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY next_fetch, url) AS rk FROM due) WHERE rk <= 30),
q AS (SELECT key FROM (SELECT key, dense_rank() OVER (ORDER BY min(next_fetch), key) AS qr FROM top GROUP BY key) WHERE qr <= 250)
SELECT url, key, {Q.fmt_ts('next_fetch')} AS next_fetch, {Q.fmt_ts(f"TIMESTAMP '{PULL_NOW}' + INTERVAL 300 SECOND")} AS leased_until
FROM top WHERE key IN (SELECT key FROM q)
""")
def q_frontier_pull(spark, sf_dir):
    t = _upserted(spark, sf_dir)
    fr = t.select("url", F.col("host").alias("key"),
                  S.schedule_score(F.col("status"), F.col("metadata"), F.col("ts"), WEIGHTS).alias("next_fetch"),
                  F.lit(None).cast("timestamp").alias("leased_until"))
    out = FR.due_urls(fr, F.lit(PULL_NOW).cast("timestamp"), max_queues=250, max_per_queue=30)
    return out.select("url", "key", S.fmt_ts("next_fetch").alias("next_fetch"), S.fmt_ts("leased_until").alias("leased_until"))


@register("status_split", f"""
WITH {SQL_SV}
SELECT event_id, url, status, CASE WHEN status = 'DISCOVERED' THEN 'log' ELSE 'status' END AS branch FROM sv
""")
def q_status_split(spark, sf_dir):
    sv = status_rows(spark, sf_dir)
    st, log = FR.split_status(sv)
    return st.select("event_id", "url", "status", F.lit("status").alias("branch")).unionByName(
        log.select("event_id", "url", "status", F.lit("log").alias("branch")))


@register("fetch_route", f"""
WITH {SQL_SV}
SELECT event_id, code,
       CASE WHEN code >= 200 AND code < 300 THEN 'FETCHED' WHEN code = 304 THEN 'FETCHED'
            WHEN code >= 300 AND code < 400 THEN 'REDIRECTION' WHEN code >= 500 AND code < 600 THEN 'FETCH_ERROR'
            ELSE 'ERROR' END AS fetch_status,
       CASE WHEN code >= 200 AND code < 300 THEN 'parse' WHEN code >= 300 AND code < 400 AND code <> 304 THEN 'status+target'
            ELSE 'status' END AS route
FROM sv
""")
def q_fetch_route(spark, sf_dir):
    sv = status_rows(spark, sf_dir)
    return sv.select("event_id", "code", FR.status_from_code("code").alias("fetch_status"),
                     FR.fetch_route("code").alias("route"))


MSG_SQL = ("CASE WHEN k < 30 THEN 'java.net.SocketTimeoutException: Read timed out' "
           "WHEN k < 60 THEN 'java.net.UnknownHostException: ' || host ELSE 'java.io.IOException: Connection reset' END")


@register("error_rows", f"""
WITH {SQL_SV}, m AS (SELECT event_id, url, {MSG_SQL} AS message FROM sv WHERE status IN ('FETCH_ERROR', 'ERROR'))
SELECT event_id, url, 'FETCH_ERROR' AS status, 'fetcher' AS error_source,
       CASE WHEN regexp_matches(message, '(?i)sockettimeout|read timed out') THEN 'Socket timeout fetching'
            WHEN regexp_matches(message, '(?i)unknownhost') THEN 'Unknown host'
            ELSE regexp_extract(regexp_extract(message, '^([A-Za-z0-9_.$]+)', 1), '([A-Za-z0-9_$]+)$', 1) END AS error_cause
FROM m
""")
def q_error_rows(spark, sf_dir):
    sv = status_rows(spark, sf_dir).filter(F.col("status").isin("FETCH_ERROR", "ERROR"))
    msg = (F.when(F.col("k") < 30, "java.net.SocketTimeoutException: Read timed out")
           .when(F.col("k") < 60, F.concat(F.lit("java.net.UnknownHostException: "), F.col("host")))
           .otherwise("java.io.IOException: Connection reset"))
    e = FR.error_rows(sv.withColumn("message", msg), "message", "fetcher")
    return e.select("event_id", "url", "status",
                    F.element_at("metadata", "error.source")[0].alias("error_source"),
                    F.element_at("metadata", "error.cause")[0].alias("error_cause"))


# ------------------------------------------------------------------ fetch planning

def _urls_by_host(spark, sf_dir):
    configure(spark)
    p = load_table(spark, sf_dir, "pages")
    return p.select("page_id", "url", U.partition_key("url", "host").alias("key"))


@register("crawl_delay_rule", f"""
SELECT DISTINCT {Q.host('url')} AS key, length({Q.host('url')}) * 1.5::DOUBLE AS robots_delay,
       CASE WHEN length({Q.host('url')}) * 1.5::DOUBLE > 30.0 THEN NULL ELSE length({Q.host('url')}) * 1.5::DOUBLE END AS delay,
       CASE WHEN length({Q.host('url')}) * 1.5::DOUBLE > 30.0 THEN 'ERROR' END AS status,
       CASE WHEN length({Q.host('url')}) * 1.5::DOUBLE > 30.0 THEN 'crawl_delay' END AS error_cause
FROM pages
""")
def q_crawl_delay_rule(spark, sf_dir):
    u = _urls_by_host(spark, sf_dir).select("key").distinct()
    r = F.length("key") * 1.5
    return FR.apply_crawl_delay(u.select("key", r.alias("robots_delay")), "robots_delay") \
        .select("key", "robots_delay", "delay", "status", "error_cause")


def _delays(urls):
    hosts = urls.select("key").distinct()
    return hosts.select("key", S.crawl_delay(F.length("key") * 1.5, force_max=True).alias("delay"))


SQL_POS = f"""up AS (SELECT page_id, url, {Q.host('url')} AS key FROM pages),
pos AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY url, page_id) AS queue_pos,
               least(length(key) * 1.5::DOUBLE, 30.0::DOUBLE) AS delay FROM up)"""


@register("politeness", f"""
WITH {SQL_POS}
SELECT page_id, url, key, queue_pos, delay, floor((queue_pos - 1) / 1) * delay AS slot_s FROM pos
""")
def q_politeness(spark, sf_dir):
    u = _urls_by_host(spark, sf_dir)
    p = FR.politeness_plan(u, _delays(u), order=("url", "page_id"))
    return p.select("page_id", "url", "key", "queue_pos", "delay", F.col("slot_s").cast("double").alias("slot_s"))


@register("round_robin", f"""
WITH {SQL_POS}
SELECT page_id, url, key, queue_pos, row_number() OVER (ORDER BY queue_pos, key) AS rr_order FROM pos
""")
def q_round_robin(spark, sf_dir):
    u = _urls_by_host(spark, sf_dir)
    p = FR.politeness_plan(u, _delays(u), order=("url", "page_id"))
    return FR.round_robin(p).select("page_id", "url", "key", "queue_pos", "rr_order")


@register("queue_report", f"""
SELECT {Q.host('url')} AS key, count(*) AS n_urls, min(url) AS first_url, max(url) AS last_url FROM pages GROUP BY 1
""")
def q_queue_report(spark, sf_dir):
    return FR.queue_report(_urls_by_host(spark, sf_dir))


@register("stale_drop", f"""
WITH {SQL_SV},
f AS (SELECT event_id, url, host AS key, ts,
             (epoch_us(TIMESTAMP '{PULL_NOW}') - epoch_us(ts)) <= 604800000000 AS fresh FROM sv),
c AS (SELECT event_id, row_number() OVER (PARTITION BY key ORDER BY ts, url, event_id) AS qp FROM f WHERE fresh)
SELECT f.event_id, f.url, f.key, f.fresh AND coalesce(c.qp <= 5, false) AS kept FROM f LEFT JOIN c USING (event_id)
""")
def q_stale_drop(spark, sf_dir):
    sv = status_rows(spark, sf_dir).select("event_id", "url", F.col("host").alias("key"), F.col("ts").alias("queued_at"))
    out = FR.queue_caps(sv, cap=5, now=F.lit(PULL_NOW).cast("timestamp"), timeout_s=604800,
                        order=("queued_at", "url", "event_id"))
    return out.select("event_id", "url", "key", "kept")


# ------------------------------------------------------------------ status log, metadata

@register("status_log", f"""
WITH {SQL_SV}
SELECT event_id,
       printf('%28s %12s %29s %8s %s %s %s', strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ'), status,
              coalesce(strftime(CASE status WHEN 'FETCHED' THEN NULL WHEN 'DISCOVERED' THEN date_trunc('minute', ts)
                   WHEN 'FETCH_ERROR' THEN {_plus(f"TIMESTAMP '{NOW}'", '120')} WHEN 'ERROR' THEN {_plus(f"TIMESTAMP '{NOW}'", '44640')}
                   WHEN 'REDIRECTION' THEN {_plus(f"TIMESTAMP '{NOW}'", '1440')} END, '%Y-%m-%dT%H:%M:%S.%gZ'), '-'),
              'DEFAULT', url, host,
              '{{"isCurlieDomain":["' || CASE WHEN k >= 50 THEN 'true' ELSE 'false' END || '"]'
              || CASE WHEN k < 30 THEN ',"isWikipediaWeblinkDomain":["true"]' ELSE '' END
              || CASE WHEN k >= 20 AND k <= 70 THEN ',"isClueWebDomain":["true"]' ELSE '' END || '}}') AS line
FROM sv
""")
def q_status_log(spark, sf_dir):
    sv = status_rows(spark, sf_dir)
    md = M.remove_key(F.col("metadata"), DATE_KEY)
    nf = S.schedule_focused(F.col("status"), F.col("metadata"), F.lit(NOW).cast("timestamp"))
    return sv.select("event_id", FR.status_log_line(F.col("ts"), F.col("status"), nf, F.col("url"), F.col("host"), md)
                     .alias("line"))


@register("meta_select", f"""
WITH {SQL_SV},
kv AS (SELECT event_id, 'isCurlieDomain' AS key FROM sv
       UNION ALL SELECT event_id, 'isWikipediaWeblinkDomain' FROM sv WHERE k < 30
       UNION ALL SELECT event_id, 'isClueWebDomain' FROM sv WHERE k >= 20 AND k <= 70)
SELECT event_id, key FROM kv
""")
def q_meta_select(spark, sf_dir):
    sv = status_rows(spark, sf_dir)
    sel = M.select_md(F.col("metadata"), M.PERSIST_KEYS)
    return sv.select("event_id", F.explode(F.map_keys(sel)).alias("key"))


@register("meta_merge", f"""
WITH {SQL_SV},
kv AS (SELECT event_id, 'isCurlieDomain' AS key, CASE WHEN k >= 50 THEN 'true' ELSE 'false' END AS value FROM sv
       UNION ALL SELECT event_id, 'isWikipediaWeblinkDomain', 'true' FROM sv WHERE k < 30
       UNION ALL SELECT event_id, 'isClueWebDomain', 'true' FROM sv WHERE k >= 20 AND k <= 70
       UNION ALL SELECT event_id, '{DATE_KEY}', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') FROM sv
       UNION ALL SELECT event_id, 'protocol.Content-Type', 'text/html' FROM sv
       UNION ALL SELECT event_id, 'fetch.statusCode', CAST(code AS VARCHAR) FROM sv)
SELECT event_id, key, value FROM kv
""")
def q_meta_merge(spark, sf_dir):
    sv = status_rows(spark, sf_dir)
    resp = F.create_map(F.lit("Content-Type"), F.array(F.lit("text/html")))
    merged = M.merge_md(F.col("metadata"), resp, prefix="protocol.")
    merged = M.set_value(merged, "fetch.statusCode", F.col("code").cast("string"))
    return sv.select("event_id", F.explode(merged).alias("key", "values")).select(
        "event_id", "key", F.array_join("values", ",").alias("value"))


@register("value_dedup", f"""
WITH {SQL_SV},
v AS (SELECT event_id, ['a' || k, 'b' || (k // 10), 'a' || k] AS vals FROM sv)
SELECT event_id, len(list_distinct(vals))::BIGINT AS n_values, array_to_string(list_sort(list_distinct(vals)), ',') AS values_sorted FROM v
""")
def q_value_dedup(spark, sf_dir):
    from trawl.operators.parse import dedup_values
    sv = status_rows(spark, sf_dir)
    vals = F.array(F.concat(F.lit("a"), F.col("k").cast("string")),
                   F.concat(F.lit("b"), F.floor(F.col("k") / 10).cast("long").cast("string")),
                   F.concat(F.lit("a"), F.col("k").cast("string")))
    md = F.create_map(F.lit("parse.meta.author"), vals)
    d = dedup_values(md, ["parse.meta.author"])
    v = F.element_at(d, F.lit("parse.meta.author"))
    return sv.select("event_id", F.size(v).cast("long").alias("n_values"), F.array_join(F.array_sort(v), ",").alias("values_sorted"))


@register("tunnelling", f"""
WITH {SQL_LP}
SELECT page_id, block_idx, link_idx, link, CASE WHEN is_content THEN 5 ELSE 4 END AS max_link_depth FROM lpd
""")
def q_tunnelling(spark, sf_dir):
    """C4 (inactive in the reference, available here): links of irrelevant blocks get
    maxLinkDepth - 1 (from the default 5)."""
    p = _prioritised(spark, sf_dir)
    return p.select("page_id", "block_idx", F.col("link_idx").cast("long").alias("link_idx"), "link",
                    L.tunnelling(F.lit(5), F.col("block_score") > 0).alias("max_link_depth"))
