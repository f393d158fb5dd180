"""URL column functions.

Everything here is a JVM-side Column expression except ``uri_escape`` (Arrow pandas UDF),
so filters stay inside whole-stage codegen and can be pushed below joins.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEME_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
ORIGIN_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
HOST_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
# Schemes a link may carry and still resolve; anything else (javascript:, data:, ...) is unresolvable.
RESOLVABLE_SCHEMES = ("http", "https", "ftp", "file", "mailto")

# URL regex rules, in file order (sign, pattern). First match decides, no match drops.
REGEX_RULES = [
    ("-", r"^(file|ftp|mailto):"),
    ("+", r"\.xml(\.gz)?(\?|&|$)"),
    ("-", r"(?i)\.(apk|deb|cab|iso|gif|jpg|png|svg|ico|css|sit|eps|wmf|rar|tar|jar|zip|gz|bz2|rpm|tgz|mov|exe|jpeg|jpe|bmp|js|mpg|mp3|mp4|m4a|ogv|kml|wmv|swf|flv|mkv|m4v|webm|ra|wma|wav|avi|xspf|m3u)(\?|&|$)"),
    ("-", r"^https?://(?:localhost|127(?:\.(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?))){3}|\[::1\])(?::\d+)?(?:/|$)"),
    ("-", r"^https?://(?:\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/|$)"),
    ("+", r"."),
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def host(url) -> Column:
    """Lower-cased host of an absolute URL, NULL when there is none."""
    return F.lower(F.nullif(F.regexp_extract(_c(url), HOST_RE, 1), F.lit("")))


def scheme(url) -> Column:
    return F.lower(F.nullif(F.regexp_extract(_c(url), r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1), F.lit("")))


# Suffixes of two labels under which names are registered, and rules of other kinds, for use
# without a rule table ("*." any one label below, "!" a name that is registered all the same).
SUFFIXES = [
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk", "police.uk", "sch.uk",
    "com.au", "net.au", "org.au", "edu.au", "gov.au", "asn.au", "id.au", "co.nz", "net.nz", "org.nz", "ac.nz", "govt.nz",
    "co.jp", "ac.jp", "go.jp", "ne.jp", "or.jp", "co.kr", "ac.kr", "go.kr", "or.kr", "com.cn", "net.cn", "org.cn",
    "edu.cn", "gov.cn", "ac.cn", "com.hk", "org.hk", "edu.hk", "com.tw", "org.tw", "edu.tw", "com.sg", "edu.sg",
    "co.in", "net.in", "org.in", "ac.in", "gov.in", "com.br", "net.br", "org.br", "gov.br", "edu.br", "com.ar",
    "org.ar", "com.mx", "org.mx", "com.tr", "org.tr", "edu.tr", "gov.tr", "co.za", "org.za", "ac.za", "gov.za",
    "co.il", "org.il", "ac.il", "com.ua", "com.pl", "net.pl", "org.pl", "edu.pl", "gov.pl", "co.at", "or.at", "ac.at",
    "gv.at", "com.es", "org.es", "gob.es", "com.fr", "gouv.fr", "asso.fr", "com.pt", "gov.pt", "gov.it", "edu.it",
    "co.id", "ac.id", "go.id", "co.th", "ac.th", "go.th", "com.my", "com.ph", "com.vn", "com.eg", "com.sa",
    "*.ck", "!www.ck"]


def _suffix_pattern(rules) -> tuple[str, str]:
    """Patterns of a host's registrable domain: by the exceptions, and by the other rules."""
    def text(r):
        return r.replace("*", "[^.]+").replace(".", r"\.").replace(r"[^\.]", "[^.]")

    names = sorted({r for r in rules if not r.startswith("!")}, key=lambda r: (-r.count("."), r))
    kept = "|".join(text(r[1:]) for r in rules if r.startswith("!")) or r"\b\B"
    return rf"(?:^|\.)({kept})$", r"(?:^|\.)([^.]+\.(?:" + "|".join([*map(text, names), "[^.]+"]) + "))$"


def domain(url, suffixes=SUFFIXES) -> Column:
    """Registrable (pay-level) domain: the public suffix and one label more; the host itself where it is an
    address or nothing more than a suffix. For a whole rule table see ``lookup.pay_level_domain``."""
    h = host(url)
    exception, rule = _suffix_pattern(suffixes)
    bare = h.rlike("^(?:" + "|".join(r.replace("*", "[^.]+").replace(".", r"\.").replace(r"[^\.]", "[^.]")
                                     for r in suffixes if not r.startswith("!")) + ")$")
    return F.when(h.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), h).otherwise(F.coalesce(
        F.nullif(F.regexp_extract(h, exception, 1), F.lit("")), F.when(bare, h),
        F.nullif(F.regexp_extract(h, rule, 1), F.lit("")), h))


def strip_fragment(url) -> Column:
    """Drop everything from the first '#'."""
    return F.regexp_replace(_c(url), r"#.*$", "")


def _bind(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def remove_dot_segments(url) -> Column:
    """'.' segments of the path go, '..' with the segment before it (one without stays); query and fragment
    are left alone."""

    def step(done, part):
        back = (part == "..") & (F.size(done) > 1) & (F.try_element_at(done, F.lit(-1)) != "..")
        return F.when(part == ".", done).when(back, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))) \
            .otherwise(F.concat(done, F.array(part)))

    def joined(parts, left):
        open_end = F.try_element_at(parts, F.lit(-1)).isin(".", "..") & (F.try_element_at(left, F.lit(-1)) != "..")
        return F.concat(F.array_join(left, "/"), F.when(open_end, "/").otherwise(""))

    def clean(u):
        start = F.regexp_extract(u, r"^((?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?)([^?#]*)", 1)
        path = F.regexp_extract(u, r"^((?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?)([^?#]*)", 2)
        rest = F.regexp_extract(u, r"(?s)^[^?#]*(.*)$", 1)
        folded = _bind(F.split(path, "/"), lambda parts: _bind(
            F.aggregate(parts, F.array().cast("array<string>"), step), lambda left: joined(parts, left)))
        return F.concat(start, folded, rest)

    u = _c(url)
    return F.when(u.contains("/.") & u.rlike(r"^[^?#]*/\.\.?([/?#]|$)"), clean(u)).otherwise(u)


def resolve(base, href) -> Column:
    """Resolve ``href`` against the absolute ``base`` URL; NULL when unresolvable."""
    b = _c(base)
    h = F.trim(_c(href))
    b_noq = F.regexp_replace(b, r"[?#].*$", "")
    origin = F.regexp_extract(b, ORIGIN_RE, 1)
    base_dir = F.when(b_noq.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*$"), F.concat(b_noq, F.lit("/"))).otherwise(
        F.regexp_extract(b_noq, r"^(.*/)", 1))
    h_scheme = F.lower(F.regexp_extract(h, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1))
    out = (
        F.when(h.isNull(), F.lit(None))
        .when(h.rlike(SCHEME_RE), F.when(h_scheme.isin(*RESOLVABLE_SCHEMES), h))
        .when(origin == "", F.lit(None))
        .when(h.startswith("//"), F.concat(scheme(b), F.lit(":"), h))
        .when(h.startswith("/"), F.concat(origin, h))
        .when(h.startswith("?"), F.concat(b_noq, h))
        .when(h.startswith("#"), F.concat(F.regexp_replace(b, r"#.*$", ""), h))
        .when(h == "", F.regexp_replace(b, r"#.*$", ""))
        .otherwise(F.concat(base_dir, h))
    )
    return _bind(out, remove_dot_segments)


def is_valid_url(url) -> Column:
    return _c(url).rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#\s]+") & ~_c(url).rlike(r"\s")


def normalise(url) -> Column:
    """Drop fragment, unmangle a query that starts with '&', lower scheme and host, NULL if invalid."""
    u = F.regexp_replace(strip_fragment(url), r"^([^?&]*)&([^?]*)$", "$1?$2")
    lowered = F.concat(F.lower(F.regexp_extract(u, ORIGIN_RE, 1)),
                       F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(.*)$", 1))
    return F.when(is_valid_url(u), lowered)


def url_id(url) -> Column:
    """SHA-256 hex of the fragment-free, dot-segment-free URL; 'ERROR' when invalid."""
    return _bind(remove_dot_segments(strip_fragment(url)),
                 lambda n: F.when(is_valid_url(n), F.sha2(n, 256)).otherwise(F.lit("ERROR")))


def partition_key(url, mode: str = "host", key=None) -> Column:
    """U4: queue key by host or domain; an incoming key wins; blank falls to host then to URL."""
    base = host(url) if mode == "host" else domain(url)
    parts = ([F.nullif(F.lower(F.trim(_c(key))), F.lit(""))] if key is not None else []) + [
        F.nullif(base, F.lit("")), host(url), F.lower(_c(url))]
    return F.coalesce(*parts)


def path_of(url) -> Column:
    return F.regexp_extract(_c(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def max_path_repetition(url) -> Column:
    """Largest number of times one non-empty path segment occurs."""
    parts = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    return F.coalesce(
        F.array_max(F.transform(parts, lambda p: F.size(F.filter(parts, lambda q: q == p)))), F.lit(0))


def basic_filter(url, max_length: int = 1024, max_repetition: int = 3) -> Column:
    """Keep URLs no longer than ``max_length`` whose path has no segment repeated ``max_repetition`` times."""
    return (F.length(_c(url)) <= max_length) & (max_path_repetition(url) < max_repetition)


def regex_filter(url, rules=REGEX_RULES) -> Column:
    """U8: ordered +/- rules with find semantics; the first rule that matches decides."""
    expr = None
    for sign, pattern in rules:
        hit = _c(url).rlike(pattern)
        expr = F.when(hit, F.lit(sign == "+")) if expr is None else expr.when(hit, F.lit(sign == "+"))
    return F.coalesce(expr.otherwise(F.lit(False)), F.lit(False))


def md5_unit(value) -> Column:
    """Deterministic uniform number in [0,1): first 32 bits of md5 / 2^32."""
    return F.conv(F.substring(F.md5(_c(value)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def epsilon_keep(url, epsilon: float = 1.0, seed: int | None = None, deterministic: bool = True) -> Column:
    """Keep with probability epsilon. Deterministic (md5) form by default so it stays movable."""
    if epsilon >= 1.0:
        return F.lit(True)
    u = md5_unit(url) if deterministic else F.rand(seed)
    return u < F.lit(float(epsilon))


def gz_sitemap_keep(url, source_md=None) -> Column:
    """U11: '.xml.gz' targets only when the source page's metadata says isSitemap=true."""
    is_sitemap = F.lit(False) if source_md is None else F.coalesce(
        F.lower(F.try_element_at(F.element_at(_c(source_md), F.lit("isSitemap")), F.lit(1))) == "true", F.lit(False))
    return ~F.lower(_c(url)).endswith(".xml.gz") | is_sitemap


def same_domain(src_url, url) -> Column:
    """Target stays within the source's domain."""
    return F.coalesce(domain(src_url) == domain(url), F.lit(False))


def materialize(df, name: str, expr: Column):
    """Add ``expr`` as column ``name`` through a one-element generator.

    A generator output is an attribute: later filters reference it instead of having the
    (long) expression substituted into every predicate by filter push-down, which keeps the
    generated code small enough for whole-stage codegen.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def chain(*predicates: Column) -> Column:
    """Conjunction of filter predicates; cheap ones should come first."""
    return reduce(lambda a, b: a & b, predicates)


@F.pandas_udf(T.StringType())
def uri_escape(urls: pd.Series) -> pd.Series:
    """Spaces to %20 and non-ASCII characters percent-encoded as UTF-8; invalid -> None."""
    from urllib.parse import quote

    def one(u):
        if u is None:
            return None
        u = u.strip().replace(" ", "%20")
        out = quote(u, safe="!#$%&'()*+,/:;=?@[]~-._")
        return out if "://" in out else None

    return urls.map(one)
