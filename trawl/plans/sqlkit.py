"""Text builders for the DuckDB oracle SQL.

Each builder writes, as SQL text, the same definition that the matching Column function in
``trawl.functions`` states with the DataFrame API; the oracles are independent re-statements
used only by the correctness check, never by the Spark jobs themselves.
"""

from __future__ import annotations

from trawl.functions import html as H
from trawl.operators.blocks import BLOCK_TAGS
from trawl.functions import urls as U


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def host(u: str) -> str:
    return f"lower(nullif(regexp_extract({u}, {lit(U.HOST_RE)}, 1), ''))"


def scheme(u: str) -> str:
    return f"lower(nullif(regexp_extract({u}, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1), ''))"


def domain(u: str) -> str:
    h = host(u)
    return (f"CASE WHEN regexp_matches({h}, '^\\d{{1,3}}(\\.\\d{{1,3}}){{3}}$') THEN {h} "
            f"ELSE coalesce(nullif(regexp_extract({h}, '([^.]+\\.[^.]+)$', 1), ''), {h}) END")


def strip_fragment(u: str) -> str:
    return f"regexp_replace({u}, '#.*$', '')"


def dot_segments(u: str) -> str:
    # RE2 has no look-around; two passes of the group form give the same result on
    # paths with at most doubled './' runs.
    x = f"regexp_replace(regexp_replace({u}, '/\\.(/|$)', '\\1', 'g'), '/\\.(/|$)', '\\1', 'g')"
    return x


def resolve(b: str, h: str) -> str:
    hh = f"trim({h})"
    b_noq = f"regexp_replace({b}, '[?#].*$', '')"
    origin = f"regexp_extract({b}, {lit(U.ORIGIN_RE)}, 1)"
    base_dir = (f"CASE WHEN regexp_matches({b_noq}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*$') THEN {b_noq} || '/' "
                f"ELSE regexp_extract({b_noq}, '^(.*/)', 1) END")
    h_scheme = f"lower(regexp_extract({hh}, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1))"
    schemes = ", ".join(lit(s) for s in U.RESOLVABLE_SCHEMES)
    out = (f"CASE WHEN {h} IS NULL THEN NULL "
           f"WHEN regexp_matches({hh}, {lit(U.SCHEME_RE)}) THEN CASE WHEN {h_scheme} IN ({schemes}) THEN {hh} END "
           f"WHEN {origin} = '' THEN NULL "
           f"WHEN starts_with({hh}, '//') THEN {scheme(b)} || ':' || {hh} "
           f"WHEN starts_with({hh}, '/') THEN {origin} || {hh} "
           f"WHEN starts_with({hh}, '?') THEN {b_noq} || {hh} "
           f"WHEN starts_with({hh}, '#') THEN regexp_replace({b}, '#.*$', '') || {hh} "
           f"WHEN {hh} = '' THEN regexp_replace({b}, '#.*$', '') "
           f"ELSE ({base_dir}) || {hh} END")
    return dot_segments(f"({out})")


def is_valid(u: str) -> str:
    return f"(regexp_matches({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#\\s]+') AND NOT regexp_matches({u}, '\\s'))"


def normalise(u: str) -> str:
    s = f"regexp_replace({strip_fragment(u)}, '^([^?&]*)&([^?]*)$', '\\1?\\2')"
    low = (f"(lower(regexp_extract({s}, {lit(U.ORIGIN_RE)}, 1)) || "
           f"regexp_extract({s}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(.*)$', 1))")
    return f"(CASE WHEN {is_valid(s)} THEN {low} END)"


def path_of(u: str) -> str:
    return f"regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def max_path_repetition(u: str) -> str:
    parts = f"list_filter(string_split({path_of(u)}, '/'), lambda s: s <> '')"
    return f"coalesce(list_max(list_transform({parts}, lambda p: len(list_filter({parts}, lambda q: q = p)))), 0)"


def basic_filter(u: str, max_length: int = 1024, max_repetition: int = 3) -> str:
    return f"(length({u}) <= {max_length} AND {max_path_repetition(u)} < {max_repetition})"


def regex_filter(u: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({u}, {lit(p)}) THEN {'true' if s == '+' else 'false'}"
                     for s, p in U.REGEX_RULES)
    return f"coalesce(CASE {whens} ELSE false END, false)"


def md5_unit(v: str) -> str:
    return f"(('0x' || substr(md5({v}), 1, 8))::BIGINT / 4294967296.0)"


def gz_keep(u: str) -> str:
    return f"(NOT ends_with(lower({u}), '.xml.gz'))"


def strip_tags(x: str) -> str:
    t = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        t = f"replace({t}, {lit(ent)}, {lit(ch)})"
    return f"trim(regexp_replace({t}, '\\s+', ' ', 'g'))"


def visible_text(html: str) -> str:
    t = f"regexp_replace({html}, '(?is)<script\\b.*?</script>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?is)<style\\b.*?</style>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?s)<!--.*?-->', ' ', 'g')"
    return strip_tags(t)


def relevance_seconds(rel: str) -> str:
    return f"floor(1.0 + 999999.0 * (1.0 - ({rel} + 1.0) / 2.0) + 0.5)::BIGINT"


def ts_from_seconds(sec: str) -> str:
    return f"make_timestamp(({sec})::BIGINT * 1000000)"


def fmt_ts(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


A_TAG_RE = lit(H.A_TAG_RE)
A_HREF_RE = lit(H.A_HREF_RE)


def attr(tag: str, name: str) -> str:
    pat = r"(?is)\b" + name + r"""\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    v = f"regexp_extract({tag}, {lit(pat)}, 0)"
    inner = f"regexp_extract({v}, {lit(r'''(?s)=\s*["'](.*)["']$''')}, 1)"
    return f"(CASE WHEN {v} <> '' THEN {inner} END)"


def directives_from_list(values: str) -> str:
    known = ", ".join(lit(x) for x in H.ROBOTS_DIRECTIVES)
    words = f"list_transform({values}, lambda v: lower(trim(v)))"
    kept = f"list_filter({words}, lambda v: v IN ({known}))"
    none = "[" + ", ".join(lit(x) for x in H.NONE_EXPANSION) + "]"
    return f"flatten(list_transform({kept}, lambda v: CASE WHEN v = 'none' THEN {none} ELSE [v] END))"


def meta_robots_content(html: str) -> str:
    tags = f"regexp_extract_all({html}, {lit(H.META_TAG_RE)}, 0)"
    robots = (f"list_filter({tags}, lambda t: coalesce(lower({attr('t', 'name')}) = 'robots', false) "
              f"AND {attr('t', 'content')} IS NOT NULL)")
    return attr(f"({robots})[1]", "content")


def meta_directives(html: str) -> str:
    mc = meta_robots_content(html)
    return f"coalesce({directives_from_list(f'string_split_regex({mc}, ' + lit(chr(92) + 's*,' + chr(92) + 's*') + ')')}, [])"


def links_ctes(pages: str = "pages") -> str:
    """CTEs ``lk_raw`` (one row per kept <a> tag) and ``lk`` (distinct targets per page in order)."""
    return f"""
lk_p AS (
  SELECT page_id, url AS src_url, html, list_contains({meta_directives('html')}, 'nofollow') AS page_nofollow
  FROM {pages}),
lk_t AS (
  SELECT page_id, src_url, page_nofollow,
         unnest(regexp_extract_all(html, {A_TAG_RE}, 1)) AS attrs,
         unnest(regexp_extract_all(html, {A_TAG_RE}, 2)) AS inner_html,
         unnest(generate_series(1, len(regexp_extract_all(html, {A_TAG_RE}, 1)))) AS pos
  FROM lk_p WHERE NOT page_nofollow),
lk_l AS (
  SELECT page_id, src_url, pos, page_nofollow, {resolve('src_url', attr('attrs', 'href'))} AS target,
         coalesce(lower(trim({attr('attrs', 'rel')})) = 'nofollow', false) AS nofollow,
         {strip_tags('inner_html')} AS anchor_text, {attr('attrs', 'href')} IS NOT NULL AS has_href
  FROM lk_t),
lk_raw AS (
  SELECT page_id, src_url, pos, target,
         CASE WHEN nofollow OR page_nofollow THEN NULL ELSE nullif(anchor_text, '') END AS anchor
  FROM lk_l WHERE has_href AND target IS NOT NULL AND NOT nofollow),
lk_d AS (SELECT page_id, src_url, target, min(pos) AS first_pos FROM lk_raw GROUP BY page_id, src_url, target),
lk AS (
  SELECT page_id, src_url, target, first_pos,
         row_number() OVER (PARTITION BY page_id ORDER BY first_pos) AS link_pos
  FROM lk_d)"""


def filtered_links_cte(epsilon: float = 1.0, source: str = "lk") -> str:
    eps = "" if epsilon >= 1.0 else f" AND {md5_unit('url')} < {float(epsilon)}"
    return f"""
fl_n AS (SELECT *, {normalise('target')} AS url FROM {source}),
fl AS (SELECT * FROM fl_n WHERE url IS NOT NULL AND {basic_filter('url')} AND {regex_filter('url')}
       AND {gz_keep('url')}{eps})"""


def tag_pattern(element: str) -> str:
    """Opening tags of ``element`` ('*' = any element) with attributes."""
    name = r"[a-zA-Z][a-zA-Z0-9]*" if element == "*" else element
    return r"(?is)<" + name + r"\s[^>]*>"


def text_pattern(element: str) -> str:
    return r"(?is)<" + element + r"(?:\s[^>]*)?>(.*?)</" + element + r"\s*>"


BOUNDARY_RE = r"(?is)</?(?:" + "|".join(BLOCK_TAGS) + r")\b[^>]*>"
DROP_RE = [r"(?is)<head\b.*?</head>", r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>",
           r"(?s)<!--.*?-->"]



def rule_values(rule, html: str = "html") -> str:
    if rule[0] == "text":
        return (f"list_transform(list_slice(regexp_extract_all({html}, {lit(text_pattern(rule[1]))}, 1), 1, 1), "
                f"lambda t: {strip_tags('t')})")
    _, element, a, v, out = rule
    tags = f"regexp_extract_all({html}, {lit(tag_pattern(element))}, 0)"
    hits = f"list_filter({tags}, lambda t: coalesce({attr('t', a)} = {lit(v)}, false))"
    return f"list_filter(list_transform({hits}, lambda t: {attr('t', out)}), lambda x: x IS NOT NULL)"


def meta_key(key: str, html: str = "html") -> str:
    from trawl.operators.parse import META_RULES
    whens = " ".join(f"WHEN len({rule_values(r, html)}) > 0 THEN {rule_values(r, html)}" for r in META_RULES[key])
    return f"(CASE {whens} END)"
