"""Graph queries: hits (H1) on the supplier -> part graph of ``lineitem``, hits_top (H2),
hits_windows (H1 + T5 on page links in windows of 100 pages), graph_json (K7, A10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.operators import graph as G
from trawl.operators.parse import extract_links
from trawl.plans import sqlkit as Q
from trawl.plans.catalog import register
from trawl.session import configure, load_table

ROUNDS = 5


def _supplier_part_edges(spark, sf_dir):
    configure(spark)
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
                     F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"))


def hits_sql(edges_cte: str, rounds: int = ROUNDS, g: str = "") -> str:
    """Unrolled Jacobi HITS in SQL; ``g`` is an optional graph key column."""
    gk = f"{g}, " if g else ""
    on = lambda a, b: (f"{a}.{g} = {b}.{g} AND " if g else "")
    part = f"PARTITION BY {g}" if g else ""
    parts = [edges_cte,
             f"n AS (SELECT {gk}src AS node FROM e UNION SELECT {gk}dst FROM e)",
             f"s0 AS (SELECT {gk}node, 1.0::DOUBLE AS hub, 1.0::DOUBLE AS auth FROM n)"]
    for t in range(1, rounds + 1):
        p = f"s{t - 1}"
        parts.append(f"""r{t} AS (SELECT {('n.' + g + ', ') if g else ''}n.node, coalesce(ai.a, 0.0) AS a, coalesce(hi.h, 0.0) AS h FROM n
  LEFT JOIN (SELECT {('e.' + g + ', ') if g else ''}e.dst AS node, sum(x.hub) AS a FROM e JOIN {p} x ON {on('e', 'x')}e.src = x.node GROUP BY ALL) ai
    ON {on('n', 'ai')}n.node = ai.node
  LEFT JOIN (SELECT {('e.' + g + ', ') if g else ''}e.src AS node, sum(x.auth) AS h FROM e JOIN {p} x ON {on('e', 'x')}e.dst = x.node GROUP BY ALL) hi
    ON {on('n', 'hi')}n.node = hi.node)""")
        parts.append(f"s{t} AS (SELECT {gk}node, h / sqrt(sum(h * h) OVER ({part})) AS hub, "
                     f"a / sqrt(sum(a * a) OVER ({part})) AS auth FROM r{t})")
    return ",\n".join(parts)


SQL_SP_EDGES = "e AS (SELECT DISTINCT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem)"


@register("hits", f"""
WITH {hits_sql(SQL_SP_EDGES)}
SELECT node, round(hub, 6) AS hub, round(auth, 6) AS authority FROM s{ROUNDS}
""")
def q_hits(spark, sf_dir):
    s = G.hits(_supplier_part_edges(spark, sf_dir), rounds=ROUNDS)
    return s.select("node", F.round("hub", 6).alias("hub"), F.round("authority", 6).alias("authority"))


@register("hits_top", f"""
WITH {hits_sql(SQL_SP_EDGES)},
th AS (SELECT 'hub' AS kind, node, round(hub, 9) AS score FROM s{ROUNDS} ORDER BY round(hub, 9) DESC, node LIMIT 10),
ta AS (SELECT 'authority' AS kind, node, round(auth, 9) AS score FROM s{ROUNDS} ORDER BY round(auth, 9) DESC, node LIMIT 10)
SELECT kind, node, round(score, 6) AS score FROM th UNION ALL SELECT kind, node, round(score, 6) FROM ta
""")
def q_hits_top(spark, sf_dir):
    s = G.hits(_supplier_part_edges(spark, sf_dir), rounds=ROUNDS)
    th = G.top_k(s, "hub", 10).select(F.lit("hub").alias("kind"), "node", F.round("hub", 6).alias("score"))
    ta = G.top_k(s, "authority", 10).select(F.lit("authority").alias("kind"), "node",
                                             F.round("authority", 6).alias("score"))
    return th.unionByName(ta)


SQL_WIN_EDGES = f"""{Q.links_ctes()},
pw AS (SELECT page_id, (row_number() OVER (ORDER BY page_id) - 1) // 100 AS graph FROM pages),
e AS (SELECT DISTINCT pw.graph, lk.src_url AS src, lk.target AS dst FROM lk JOIN pw USING (page_id))"""


@register("hits_windows", f"""
WITH {hits_sql(SQL_WIN_EDGES, g='graph')}
SELECT graph, node, round(hub, 6) AS hub, round(auth, 6) AS authority FROM s{ROUNDS}
""")
def q_hits_windows(spark, sf_dir):
    configure(spark)
    pages = G.count_windows(load_table(spark, sf_dir, "pages"), "page_id", 100)
    links = extract_links(pages.select("page_id", "url", "html")).join(pages.select("page_id", "graph"), "page_id")
    s = G.hits(links.select("graph", F.col("src_url").alias("src"), F.col("target").alias("dst")), rounds=ROUNDS,
               graph_col="graph")
    return s.select("graph", "node", F.round("hub", 6).alias("hub"), F.round("authority", 6).alias("authority"))


@register("graph_json", f"""
WITH {Q.links_ctes()},
e AS (SELECT DISTINCT src_url AS src, target AS dst FROM lk)
SELECT src, '{{"' || src || '":[' || string_agg('"' || dst || '"', ',' ORDER BY dst) || ']}}' AS json FROM e GROUP BY src
""")
def q_graph_json(spark, sf_dir):
    configure(spark)
    links = extract_links(load_table(spark, sf_dir, "pages"))
    return G.graph_json(links.select(F.col("src_url").alias("src"), F.col("target").alias("dst")))
