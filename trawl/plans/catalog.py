"""Registry of the named queries exposed through ``__spark_entry__``.

Every query reads the given tables (or data Spark derives from them) over their whole
extent; an oracle SQL text is attached where DuckDB can state the same result.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}

MODULES = (
    "trawl.plans.queries_links",
    "trawl.plans.queries_urls",
    "trawl.plans.queries_parse",
    "trawl.plans.queries_lookup",
    "trawl.plans.queries_blocks",
    "trawl.plans.queries_relevance",
    "trawl.plans.queries_embed",
    "trawl.plans.queries_schedule",
    "trawl.plans.queries_graph",
    "trawl.plans.queries_evaluate",
    "trawl.plans.queries_monitor",
    "trawl.plans.queries_warc",
    "trawl.plans.queries_varied",
)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


def _load():
    for m in MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:
            if e.name != m:
                raise


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
