"""URL filter chain over link DataFrames.

Filters are Column predicates folded into one conjunction (cheap ones first) so Catalyst can
push them next to the scan; the deny list is a left-anti join placed last, broadcast only
after its row count is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import urls as U
from trawl.session import broadcast_if_small

DEFAULT_STEPS = ("depth", "basic", "normalise", "regex", "epsilon", "gz", "deny")


def depth_keep(md: Column | None, max_depth: int = 20) -> Column:
    """Drop when the carried depth exceeds ``max_depth``."""
    if md is None:
        return F.lit(True)
    d = F.try_element_at(F.element_at(md, F.lit("depth")), F.lit(1)).try_cast("int")
    return F.coalesce(d <= max_depth, F.lit(True))


def deny(links: DataFrame, denylist: DataFrame, url_col: str = "url", md: Column | None = None,
         compat: bool = False, check_size: bool = True) -> DataFrame:
    """Drop URLs on the deny list; a source ``maxLinkDepth`` <= -1 also drops.

    ``compat=True`` reproduces the reference's branch where any carried ``maxLinkDepth``
    makes the filter return nothing.
    """
    out = links
    if md is not None:
        mld = F.try_element_at(F.element_at(md, F.lit("maxLinkDepth")), F.lit(1))
        if compat:
            out = out.filter(mld.isNull())
        else:
            out = out.filter(F.coalesce(mld.try_cast("double") > -1, F.lit(True)))
    keys = denylist.select(F.col("url").alias(url_col)).distinct()
    if check_size:
        # a deny list read from a file: counting it is cheap, broadcast under the bound
        keys, _ = broadcast_if_small(keys)
    # otherwise (a list derived inside the same job) AQE's runtime size decides
    return out.join(keys, url_col, "left_anti")


def filter_chain(links: DataFrame, target_col: str = "target", steps=DEFAULT_STEPS, epsilon: float = 1.0,
                 max_depth: int = 20, max_length: int = 1024, max_repetition: int = 3,
                 source_md: Column | None = None, denylist: DataFrame | None = None,
                 src_col: str | None = None, same_domain: bool = False, check_deny_size: bool = True) -> DataFrame:
    """Run the configured steps in order; output keeps the links with normalised ``url``."""
    out = U.materialize(links.drop("url") if "url" in links.columns else links, "url",
                        U.normalise(target_col) if "normalise" in steps else F.col(target_col))
    preds: list[Column] = [F.col("url").isNotNull()]
    for step in steps:
        if step == "depth":
            preds.append(depth_keep(source_md, max_depth))
        elif step == "basic":
            preds.append(U.basic_filter("url", max_length, max_repetition))
        elif step == "regex":
            preds.append(U.regex_filter("url"))
        elif step == "epsilon":
            preds.append(U.epsilon_keep("url", epsilon))
        elif step == "gz":
            preds.append(U.gz_sitemap_keep("url", source_md))
    if same_domain and src_col is not None:
        preds.append(U.same_domain(src_col, "url"))
    out = out.filter(U.chain(*preds))
    if "deny" in steps and denylist is not None:
        out = deny(out, denylist, "url", check_size=check_deny_size)
    return out
