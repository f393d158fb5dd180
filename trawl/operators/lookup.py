"""Lookup joins.

Lookup lists are joined, never loaded into task memory by hand: a list is broadcast only
after its row count is checked (``broadcast_if_small``), otherwise the join shuffles and
AQE splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import urls as U
from trawl.session import broadcast_if_small


def _numbered_lines(spark, path: str) -> DataFrame:
    """Lines with their file and a line order (increasing within a file), header flag set on
    each file's first line."""
    df = spark.read.text(path).withColumn("_file", F.input_file_name()) \
        .withColumn("_n", F.monotonically_increasing_id())
    first = df.groupBy("_file").agg(F.min("_n").alias("_first"))  # one row per file
    return df.join(F.broadcast(first), "_file").withColumn("_is_header", F.col("_n") == F.col("_first")).drop("_first")


def read_labels(spark, path: str) -> DataFrame:
    """S6: 'host,label' CSV with a header; split on the first comma, both parts trimmed, blank
    parts dropped; for a repeated host the last line wins. Returns (host, label)."""
    df = _numbered_lines(spark, path).filter(~F.col("_is_header"))
    return labels_from_lines(df, "value", "_n")


def labels_from_lines(df: DataFrame, value_col: str = "value", order_col: str = "_n") -> DataFrame:
    parts = F.split(F.col(value_col), ",", 2)
    rows = df.select(F.trim(F.try_element_at(parts, F.lit(1))).alias("host"),
                     F.trim(F.try_element_at(parts, F.lit(2))).alias("label"), F.col(order_col).alias("_n"))
    rows = rows.filter((F.size(parts) == 2) & (F.col("host") != "") & (F.col("label") != ""))
    return rows.groupBy("host").agg(F.max_by("label", "_n").alias("label"))


def attach_label(pages: DataFrame, labels: DataFrame, url_col: str = "url", out_col: str = "curlieLabel") -> DataFrame:
    """Left join on the page host; the label is attached when found."""
    lab, _ = broadcast_if_small(labels.select(F.col("host").alias("_h"), F.col("label").alias(out_col)))
    return pages.join(lab, U.host(url_col) == F.col("_h"), "left").drop("_h")


def key_of(value: Column, mode: str = "domain") -> Column:
    """S7/J2 key: registrable domain of a URL (or of a bare host), or the URL itself."""
    v = F.trim(value)
    as_url = F.when(v.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), v).otherwise(F.concat(F.lit("http://"), v))
    if mode == "domain":
        return U.domain(as_url)
    return F.nullif(v, F.lit(""))


def read_keys(spark, path: str, mode: str = "domain") -> DataFrame:
    """One key per line, trimmed, mapped to its domain or kept as URL, nulls dropped, distinct."""
    return keys_from(spark.read.text(path), "value", mode)


def keys_from(df: DataFrame, col: str, mode: str = "domain") -> DataFrame:
    return df.select(key_of(F.col(col), mode).alias("key")).filter(F.col("key").isNotNull()).distinct()


def flag_membership(pages: DataFrame, keys: DataFrame, mode: str = "domain", url_col: str = "url",
                    out_col: str = "isCurlieDomain") -> DataFrame:
    """J2: "true"/"false" whether the page's key is in the set; a NULL key is "false"."""
    k, _ = broadcast_if_small(keys.select(F.col("key").alias("_k")).distinct().withColumn("_in", F.lit(True)))
    pk = key_of(F.col(url_col), mode)
    return pages.join(k, pk == F.col("_k"), "left").withColumn(
        out_col, F.coalesce(F.col("_in"), F.lit(False)).cast("string")).drop("_k", "_in")


def read_suffixes(spark, path: str) -> DataFrame:
    """A public-suffix file: one rule per line up to the first white space, comments after ``//``."""
    rule = F.lower(F.regexp_extract("value", r"^\s*(\S*)", 1))
    return spark.read.text(path).select(rule.alias("rule")).where((F.col("rule") != "") & ~F.col("rule").startswith("//"))


def pay_level_domain(df: DataFrame, rules: DataFrame, url_col: str = "url", out_col: str = "domain") -> DataFrame:
    """U4: ``df`` with the registrable domain of its URL by a whole rule table (``rule``: a suffix, ``*.`` for any
    one label below it, ``!`` for an exception). Every suffix of each distinct host is looked up; an exception
    decides, else the longest rule, else the last label. Hosts that are addresses or only a suffix stay."""
    body = F.regexp_replace("rule", r"^(?:!|\*\.)", "")
    table = rules.select(body.alias("_suffix"), F.col("rule").startswith("!").alias("_not"),
                         F.col("rule").startswith("*.").cast("int").alias("_more")).distinct()
    table, _ = broadcast_if_small(table)
    hosts = df.select(U.host(url_col).alias("_host")).where("_host is not null").distinct()
    labels, n = F.split("_host", r"\."), F.size(F.split("_host", r"\."))
    tails = hosts.select("_host", F.explode(F.sequence(F.lit(1), n)).alias("_size"))
    tails = tails.withColumn("_suffix", F.array_join(F.slice(labels, n - F.col("_size") + 1, F.col("_size")), "."))
    found = tails.join(table, "_suffix", "left").groupBy("_host").agg(
        F.max(F.when(F.col("_not"), F.col("_size") - 1)).alias("_kept"),
        F.max(F.when(~F.col("_not") & (F.col("_size") + F.col("_more") <= n), F.col("_size") + F.col("_more"))).alias("_rule"))
    size = F.coalesce("_kept", F.greatest(F.col("_rule"), F.lit(1)))
    own = F.when(F.col("_host").rlike(r"^\d{1,3}(\.\d{1,3}){3}$") | (n <= size), F.col("_host")).otherwise(
        F.array_join(F.slice(labels, F.greatest(n - size, F.lit(1)), size + 1), "."))
    domains, _ = broadcast_if_small(found.select("_host", own.alias(out_col)))
    return df.join(domains, U.host(url_col) == F.col("_host"), "left").drop("_host")


def read_denylist(spark, path: str, allow: str = "Science") -> DataFrame:
    """Split on every comma; lines with exactly two parts whose label is not ``allow``
    (case-insensitive); the key is the trimmed first part. Returns (url, label)."""
    return denylist_from_lines(spark.read.text(path), "value", allow)


def denylist_from_lines(df: DataFrame, col: str = "value", allow: str = "Science") -> DataFrame:
    parts = F.split(F.col(col), ",")
    ok = (F.size(parts) == 2) & (F.lower(F.trim(F.try_element_at(parts, F.lit(2)))) != allow.lower())
    return df.filter(ok).select(F.trim(F.try_element_at(parts, F.lit(1))).alias("url"),
                                F.trim(F.try_element_at(parts, F.lit(2))).alias("label"))


def first_seen(rows: DataFrame, order_cols, url_col: str = "url") -> DataFrame:
    """J5/T2 (batch): the first arrival of each fragment-free URL proceeds (``first`` true), later
    arrivals are flagged (they become FETCHED rows). First = minimum of ``order_cols``: a
    partial aggregation, then a join back on the URL."""
    norm = U.strip_fragment(url_col)
    firsts = rows.groupBy(norm.alias("_norm")).agg(F.min(F.struct(*order_cols)).alias("_first"))
    j = rows.withColumn("_norm", norm).join(firsts, "_norm")
    return j.withColumn("first", F.struct(*order_cols) == F.col("_first")).drop("_first")


def apply_robots(urls: DataFrame, rules: DataFrame, sitemaps: DataFrame | None = None, url_col: str = "url",
                 discovery: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """The longest matching rule of the host decides (no match: allowed; of equally long ones, an
    allowing one). In a rule ``*`` stands for any characters and a last ``$`` for the end of path and query;
    an empty rule matches nothing.

    ``rules(host, prefix, allow)`` are gathered per host into one array (bounded by the size of a
    robots file) and matched inside the URL's row, so no (URL, rule) pairs are produced.
    Returns (urls with ``allowed``, ``status`` and ``error_cause``; sitemap status rows of
    allowed hosts when ``discovery``)."""
    closed = F.col("prefix").endswith("$")
    body = F.when(closed, F.col("prefix").substr(F.lit(1), F.length("prefix") - 1)).otherwise(F.col("prefix"))
    quoted = F.transform(F.split(body, r"\*"), lambda s: F.concat(F.lit("\\Q"), F.replace(s, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    pattern = F.concat(F.lit("(?s)^"), F.array_join(quoted, ".*"), F.when(closed, "$").otherwise(""))
    plain = ~F.col("prefix").contains("*") & ~closed
    per_host = rules.where(F.length("prefix") > 0).groupBy(F.col("host").alias("_rh")).agg(F.collect_list(F.struct(
        "prefix", "allow", F.when(~plain, pattern).alias("pattern"))).alias("_rules"))
    per_host, _ = broadcast_if_small(per_host)
    h = U.host(url_col)
    path = F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1)
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    j = urls.join(per_host, h == F.col("_rh"), "left")
    matching = F.filter(F.coalesce(F.col("_rules"), F.array().cast("array<struct<prefix:string,allow:boolean,pattern:string>>")),
                        lambda r: F.when(r["pattern"].isNull(), path.startswith(r["prefix"])).otherwise(F.rlike(path, r["pattern"])))
    longest = F.array_max(F.transform(matching, lambda r: F.struct(F.length(r["prefix"]).alias("len"), r["allow"].alias("allow"))))
    best = F.struct(F.coalesce(longest["allow"], F.lit(True)).alias("allow"))
    out = j.withColumn("allowed", best["allow"]).drop("_rules", "_rh")
    out = out.withColumn("status", F.when(F.col("allowed"), F.lit(None).cast("string")).otherwise(F.lit("ERROR"))) \
        .withColumn("error_cause", F.when(F.col("allowed"), F.lit(None).cast("string")).otherwise(F.lit("robots.txt")))
    sm = None
    if sitemaps is not None and discovery:
        allowed_hosts = out.filter("allowed").select(h.alias("host")).distinct()
        sm = sitemaps.join(allowed_hosts, "host", "left_semi").select(
            F.col("sitemap").alias("url"), F.lit("DISCOVERED").alias("status"), F.lit("true").alias("isSitemap"))
    return out, sm
