"""Scheduling column functions: relevance to fetch date (C1, C2), schedulers (F1-F4), crawl delay.

Dates are TIMESTAMP columns in a UTC session; "now" is always a parameter (a Column or a
literal), never ``current_timestamp()``, so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARENT_INFLUENCE = 0.3
MAX_SECONDS = 1_000_000

# Quality flags and the configuration keys of their weights, in this order.
QUALITY_SCORES = [
    ("isCurlieDomain", "quality.score.curlie"),
    ("isWikipediaWeblinkDomain", "quality.score.wikipediaWeblinks"),
    ("isClueWebDomain", "quality.score.clueWeb"),
]

DEFAULT_INTERVAL = 1440       # minutes, FETCHED / REDIRECTION
FETCH_ERROR_INTERVAL = 120    # minutes
ERROR_INTERVAL = 44640        # minutes


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def link_relevance(page_relevance, block_score) -> Column:
    """Parent page relevance weighted by 0.3 plus the block's adjusted score."""
    return _c(page_relevance) * F.lit(PARENT_INFLUENCE) + _c(block_score)


def relevance_seconds(rel) -> Column:
    """Seconds after the epoch; higher relevance gives an earlier date. Not clamped."""
    x = F.lit(1.0) + F.lit(float(MAX_SECONDS - 1)) * (F.lit(1.0) - (_c(rel) + F.lit(1.0)) / F.lit(2.0))
    return F.floor(x + F.lit(0.5)).cast("long")


def relevance_to_date(rel) -> Column:
    return F.timestamp_seconds(relevance_seconds(rel))


def truncate_minute(ts) -> Column:
    return F.date_trunc("minute", _c(ts))


def add_minutes(ts, minutes) -> Column:
    return F.timestamp_add("MINUTE", _c(minutes), _c(ts))


def first_value(md, key: str) -> Column:
    return F.try_element_at(F.element_at(_c(md), F.lit(key)), F.lit(1))


def quality_delay(md, base, weights: dict[str, float] | None = None) -> Column:
    """minutes = int(base - share * base), at least 0; base -1 stays -1.

    share = sum of the weights of the quality flags present and not "false", clamped to [-1, 1].
    Weights are DOUBLE (a FLOAT 0.3 widened to double would turn 7 into 6).
    """
    weights = weights or {}
    share = F.lit(0.0)
    for flag, _key in QUALITY_SCORES:
        w = float(weights.get(flag, 0.0))
        v = first_value(md, flag)
        share = share + F.when(v.isNotNull() & (v != "false"), F.lit(w)).otherwise(F.lit(0.0))
    share = F.greatest(F.least(share, F.lit(1.0)), F.lit(-1.0))
    b = _c(base)
    minutes = F.greatest((b.cast("double") + share * F.lit(-1.0) * b.cast("double")).cast("int"), F.lit(0))
    return F.when(b == -1, F.lit(-1)).otherwise(minutes)


def schedule_focused(status, md, now, fetch_error: int = FETCH_ERROR_INTERVAL,
                     error: int = ERROR_INTERVAL, redirection: int = DEFAULT_INTERVAL,
                     date_key: str = "status.store.as.is.with.nextfetchdate") -> Column:
    """FETCHED never; DISCOVERED at the carried date cut to whole minutes (never without one);
    FETCH_ERROR / ERROR / REDIRECTION now + interval; an interval of -1 means never (NULL)."""
    s = _c(status)
    carried = F.try_to_timestamp(first_value(md, date_key)) if md is not None else F.lit(None).cast("timestamp")

    def plus(m):
        return F.lit(None).cast("timestamp") if m == -1 else add_minutes(now, F.lit(m))

    return (F.when(s == "FETCHED", F.lit(None).cast("timestamp"))
            .when(s == "DISCOVERED", truncate_minute(carried))
            .when(s == "FETCH_ERROR", plus(fetch_error))
            .when(s == "ERROR", plus(error))
            .when(s == "REDIRECTION", plus(redirection))
            .otherwise(_c(now)))


def schedule_score(status, md, now, weights: dict[str, float] | None = None,
                   default: int = DEFAULT_INTERVAL, fetch_error: int = FETCH_ERROR_INTERVAL,
                   error: int = ERROR_INTERVAL) -> Column:
    """FETCHED now + F4(default); DISCOVERED now; errors and redirection by interval."""
    s = _c(status)
    minutes = (F.when(s == "FETCHED", quality_delay(md, F.lit(default), weights))
               .when(s == "FETCH_ERROR", F.lit(fetch_error))
               .when(s == "ERROR", F.lit(error))
               .when(s == "REDIRECTION", F.lit(default))
               .otherwise(F.lit(0)))
    return F.when(minutes == -1, F.lit(None).cast("timestamp")).otherwise(add_minutes(now, minutes))


def adaptive_interval(signature, signature_old, previous_interval, min_interval: int = 60,
                      max_interval: int = 44640) -> Column:
    """F3 base interval (our rule): unchanged content doubles the interval, changed halves it,
    first sight keeps it; bounded to [min_interval, max_interval] minutes."""
    prev = _c(previous_interval)
    nxt = (F.when(_c(signature_old).isNull(), prev)
           .when(_c(signature) == _c(signature_old), prev * 2)
           .otherwise(F.floor(prev / 2).cast("int")))
    return F.least(F.greatest(nxt, F.lit(min_interval)), F.lit(max_interval))


def schedule_adaptive(md, now, base_minutes, weights: dict[str, float] | None = None) -> Column:
    """now + F4(adaptive base)."""
    m = quality_delay(md, base_minutes, weights)
    return F.when(m == -1, F.lit(None).cast("timestamp")).otherwise(add_minutes(now, m))


def crawl_delay(robots_delay, default_delay: float = 1.0, max_delay: float = 30.0,
                force_max: bool = False, force_default: bool = False) -> Column:
    """delay in seconds for a queue; NULL means the URL is refused (ERROR crawl_delay).

    robots delay > max: forced to max when ``force_max`` else refused; a robots delay below
    the default when ``force_default``: the default; otherwise the robots delay (default if none).
    """
    r = _c(robots_delay).cast("double")
    return (F.when(r.isNull() | (r < 0), F.lit(default_delay))
            .when(r > F.lit(max_delay), F.lit(max_delay) if force_max else F.lit(None).cast("double"))
            .when(F.lit(force_default) & (r < F.lit(default_delay)), F.lit(default_delay))
            .otherwise(r))


def fmt_ts(ts) -> Column:
    """Timestamp as 'yyyy-MM-dd HH:mm:ss' text (the comparable form used by query outputs)."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")
