"""Block segmentation.

A page is cut into text blocks at block-level tags, in document order. Features (words, words
inside links, link density) and the neighbour-based content rule are computed on the page's
own array of blocks, so the whole segmentation is row-local: no shuffle, no window. Blocks
are then exploded into ``blocks(page_id, url, block_idx, text, is_content, n_words,
link_density, links)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import tags as T
from trawl.functions import urls as U

# Fixed values (ours): tags that start or end a text block.
BLOCK_TAGS = ["p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "td", "th", "tr", "table",
              "article", "section", "nav", "header", "footer", "aside", "blockquote", "pre", "br", "body",
              "html", "main", "form", "dd", "dt", "dl", "figure", "figcaption"]
MIN_WORDS = 5

# Content rule thresholds (number-of-words classifier, Kohlschuetter et al., WSDM 2010).
MAX_LINK_DENSITY = 1.0 / 3.0
PREV_LINK_DENSITY = 5.0 / 9.0


def is_content(w, ld, w_prev, ld_prev, w_next) -> Column:
    """B3 rule on the block's words and link density and its neighbours' (missing = 0)."""
    return (F.when(ld > MAX_LINK_DENSITY, F.lit(False))
            .when(ld_prev <= PREV_LINK_DENSITY, (w > 16) | (w_next > 15) | (w_prev > 4))
            .otherwise((w > 40) | (w_next > 17)))


def block_arrays(pages: DataFrame, min_words: int = MIN_WORDS, url_col: str = "url",
                 key_cols=("page_id",)) -> DataFrame:
    """Per page the array ``_blocks`` of kept blocks (text, raw html, words, link density, content flag)."""
    # one scan of the page; the neighbour lookups below index into its column
    base = pages.select(*key_cols, F.col(url_col).alias("url"), T.pieces("html", BLOCK_TAGS).alias("_f"))

    def ld(b):
        return F.coalesce(b["lw"] / F.when(b["w"] > 0, b["w"]), F.lit(0.0))

    f = F.col("_f")
    classified = F.transform(f, lambda b, i: F.struct(
        b["text"].alias("text"), b["hrefs"].alias("hrefs"), b["w"].alias("w"), ld(b).alias("ld"),
        is_content(b["w"], ld(b),
                   F.when(i > 0, F.try_element_at(f, F.greatest(i, F.lit(1)))["w"]).otherwise(0),
                   F.when(i > 0, ld(F.try_element_at(f, F.greatest(i, F.lit(1))))).otherwise(0.0),
                   F.coalesce(F.try_element_at(f, i + 2)["w"], F.lit(0))).alias("is_content")))
    kept = F.filter(classified, lambda b: b["w"] >= min_words)
    return U.materialize(base, "_blocks", kept).drop("_f")


def segment_pages(pages: DataFrame, min_words: int = MIN_WORDS, url_col: str = "url",
                  key_cols=("page_id",)) -> DataFrame:
    """Blocks of every page; B2's word cut after classification, before links."""
    arr = block_arrays(pages, min_words, url_col, key_cols)
    ex = arr.select(*key_cols, "url", F.posexplode("_blocks").alias("block_idx", "b"))
    links = F.filter(F.transform("b.hrefs", lambda h: U.strip_fragment(U.resolve(F.col("url"), h))),
                     lambda x: x.isNotNull() & (x != ""))
    return ex.select(*key_cols, "url", F.col("block_idx").cast("long").alias("block_idx"),
                     F.col("b.text").alias("text"), F.col("b.is_content").alias("is_content"),
                     F.col("b.w").cast("long").alias("n_words"), F.col("b.ld").alias("link_density"),
                     links.alias("links"))


def page_text(pages: DataFrame, min_words: int = MIN_WORDS, url_col: str = "url",
              key_cols=("page_id",)) -> DataFrame:
    """Concatenation of the content block texts (no separator), in block order.

    Computed on the page's own block array: no grouping, no shuffle."""
    arr = block_arrays(pages, min_words, url_col, key_cols)
    content = F.filter("_blocks", lambda b: b["is_content"])
    return arr.select(*key_cols, "url", F.array_join(F.transform(content, lambda b: b["text"]), "").alias("content_text"),
                      F.size(content).cast("long").alias("n_content_blocks"))


def block_links(blocks: DataFrame, key_cols=("page_id",)) -> DataFrame:
    """One row per (block, link position, link)."""
    return blocks.select(*key_cols, "url", "block_idx", "is_content",
                         F.posexplode("links").alias("link_idx", "link"))


def blocks_with_links(pages: DataFrame, url_col: str = "url", key_cols=("page_id",)) -> DataFrame:
    """One row per block: ``annotated`` (its text with ``|LINK_n|`` for the page's n-th link), ``text`` (anchors
    put back by number, in order) and ``links`` (the targets, resolved, without fragment; unresolvable ones are
    left out). All inside the page's row."""
    base = pages.select(*key_cols, F.col(url_col).alias("url"), T.annotated("html", BLOCK_TAGS).alias("_a"))
    base = U.materialize(base.withColumnRenamed("_a", "_scan"), "_a", F.col("_scan"))
    rows = base.select(*key_cols, "url", F.col("_a.links").alias("_links"), F.posexplode("_a.texts").alias("block_idx", "annotated"))
    numbers = F.transform(F.regexp_extract_all("annotated", F.lit(r"\|LINK_(\d{1,9})\|"), 1), lambda n: n.cast("int"))
    numbers = F.filter(numbers, lambda n: n < F.size("_links"))  # a page may hold such text itself
    rows = U.materialize(rows, "_numbers", numbers)
    text = F.aggregate("_numbers", F.col("annotated"), lambda done, n: F.replace(
        done, F.concat(F.lit("|LINK_"), n.cast("string"), F.lit("|")), F.try_element_at("_links", n + 1)["anchor"]))
    links = F.filter(F.transform("_numbers", lambda n: U.strip_fragment(
        U.resolve(F.col("url"), F.try_element_at("_links", n + 1)["href"]))), lambda x: x.isNotNull() & (x != ""))
    squeezed = F.trim(F.regexp_replace(text, r"\s+", " "))  # an empty anchor leaves two spaces
    return rows.select(*key_cols, "url", F.col("block_idx").cast("long").alias("block_idx"), "annotated", squeezed.alias("text"),
                       links.alias("links"))


def drop_empty(pages_blocks: DataFrame, key_cols=("page_id",)):
    """Pages without a content block fail; returns (kept pages' blocks, failed page keys)."""
    has = pages_blocks.groupBy(*key_cols).agg(F.max(F.col("is_content").cast("int")).alias("_c"))
    ok = has.filter(F.col("_c") == 1).select(*key_cols)
    bad = has.filter(F.col("_c") == 0).select(*key_cols)
    return pages_blocks.join(ok, list(key_cols), "left_semi"), bad
