"""trawl: focused web-crawl analytics as Spark DataFrame, SQL and Structured Streaming jobs.

Layout
------
functions/   Column -> Column building blocks (URLs, robots directives, metadata maps,
             schedules, archive header fields).
operators/   DataFrame -> DataFrame operators (parsing, filtering, lookups, blocks,
             embeddings, relevance, link priority, scheduling, graph ranking,
             evaluation, monitoring, archive rows).
sources/     readers for seed lists, lookup files, vectors, graphs, sitemaps, archives.
sinks/       writers for archives, status logs, graph exports and index tables.
plans/       composed jobs (crawl step, archive export) and the registered query catalog.
streaming/   Structured Streaming forms of the crawl step, dedup and metric buckets.
"""

from trawl.session import get_session, ensure_checkpoint_dir, load_table

__all__ = ["get_session", "ensure_checkpoint_dir", "load_table"]
