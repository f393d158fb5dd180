"""Extension surface (X1-X6): named, parameterised building blocks that a job definition can
list by name, the way the reference lists filters and schedulers in its configuration.

X1 URL filters: name -> factory(**params) -> (src_url, src_md, url) -> Column predicate
X2 parse filters: name -> (DataFrame, **params) -> DataFrame
X3 schedulers: name -> (status, md, now, **params) -> Column next-fetch date
X4 embedding models: name -> factory(**params) -> texts -> matrix
X5 jobs: Python functions composing DataFrames (``trawl.plans``), no YAML runtime
X6 quality weights: flag -> weight
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import meta as M
from trawl.functions import schedule as S
from trawl.functions import urls as U
from trawl.operators import embed as E
from trawl.operators import parse as P

URL_FILTERS: dict[str, Callable[..., Callable[[Column, Column, Column], Column]]] = {
    "depth": lambda max_depth=20: lambda src, md, url: F.coalesce(
        M.first(md, "depth").try_cast("int") <= max_depth, F.lit(True)),
    "basic": lambda max_length=1024, max_repetition=3: lambda src, md, url: U.basic_filter(url, max_length, max_repetition),
    "normalise": lambda: lambda src, md, url: U.normalise(url).isNotNull(),
    "regex": lambda rules=None: lambda src, md, url: U.regex_filter(url, rules or U.REGEX_RULES),
    "epsilon": lambda epsilon=1.0: lambda src, md, url: U.epsilon_keep(url, epsilon),
    "gz": lambda: lambda src, md, url: U.gz_sitemap_keep(url, md),
    "same_domain": lambda: lambda src, md, url: U.same_domain(src, url),
}

PARSE_FILTERS: dict[str, Callable[..., DataFrame]] = {
    "signature": lambda df, previous=None: P.signature(df, previous),
    "xpath": lambda df, rules=None: P.extract_meta(df, rules),
    "sitemap_origin": lambda df, md_col="metadata": df.withColumn(
        "isDiscoveredOnSitemap", P.on_sitemap(F.col(md_col))),
}

SCHEDULERS: dict[str, Callable[..., Column]] = {
    "focused": lambda status, md, now, **kw: S.schedule_focused(status, md, now, **kw),
    "score": lambda status, md, now, weights=None, **kw: S.schedule_score(status, md, now, weights, **kw),
    "adaptive": lambda status, md, now, base=None, weights=None: S.schedule_adaptive(
        md, now, base if base is not None else F.lit(S.DEFAULT_INTERVAL), weights),
}

EMBEDDING_MODELS: dict[str, Callable[..., Callable]] = {
    "hashing": lambda dims=64: E.hashing_model(dims),
}

QUALITY_WEIGHTS: dict[str, float] = {flag: 0.0 for flag, _ in S.QUALITY_SCORES}


def url_filter(name: str, **params) -> Callable[[Column, Column, Column], Column]:
    return URL_FILTERS[name](**params)


def apply_url_filters(links: DataFrame, chain: list[tuple[str, dict]], src_col: str = "src_url",
                      md_col: str | None = None, url_col: str = "url") -> DataFrame:
    """U13 from a configuration list [(name, params), ...]: one conjunction, evaluated in order."""
    md = F.col(md_col) if md_col else M.empty_md()
    pred = F.lit(True)
    for name, params in chain:
        pred = pred & url_filter(name, **params)(F.col(src_col), md, F.col(url_col))
    return links.filter(pred)


def register_url_filter(name: str, factory: Callable[..., Callable[[Column, Column, Column], Column]]) -> None:
    URL_FILTERS[name] = factory


def register_scheduler(name: str, fn: Callable[..., Column]) -> None:
    SCHEDULERS[name] = fn


def register_model(name: str, factory: Callable[..., Callable]) -> None:
    EMBEDDING_MODELS[name] = factory
