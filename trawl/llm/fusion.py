"""Language identification by Bayesian evidence fusion (operator 4).

Text evidence: byte-trigram log likelihoods per language, from counts over a bounded sample of
rows with a known language (``SAMPLE_ROWS``). Declared markup language and address suffix: tables
P(value | language) estimated by grouped aggregation of the text posteriors, smoothed by one
pseudo-count per language towards the language's overall share. Host prior: the posterior mass of
each language on the host, smoothed towards the host's parent domain, that towards the global
shares (``STRENGTH`` pseudo-documents at each level). The log evidences are added per document.

Per-document likelihoods are written once to a table; the grouped sums are partial on the map
side, so a hot host is one row per task. A host is joined back by a plain join (adaptive execution
splits a hot one).

Defined results: a null or empty text has no text evidence and is decided by the other evidence;
without any evidence, or with posterior below ``accept_at``, the row is not accepted (lang is then
"und" if there was no evidence at all). Null declared, suffix or host give no evidence of that
kind. One row per input row; ties go to the smaller language code; an empty table gives an empty
result; without training rows every row is "und".
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.store import bounded, persist
from trawl.llm.text import LOWER, blocks

CELLS = 1 << 15
SAMPLE_ROWS = 8_000
STRENGTH = 20.0
#: A text counts for at most so many trigrams: they are far from independent.
TEXT_WEIGHT = 200.0


def _cells(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Cell of the trigram that starts at each byte; the last two of a document have cell CELLS."""
    if len(data) < 3:
        return np.full(len(data), CELLS)
    b = LOWER[data].astype(np.int64)
    c = np.full(len(b), CELLS)
    c[:-2] = ((b[:-2] * 7919 + b[1:-1] * 104729 + b[2:] * 1299709) >> 3) % CELLS
    for k in (1, 2):
        at = off[1:] - k
        c[at[at >= off[:-1]]] = CELLS
    return c


def trigram_tables(docs: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log P(cell | language)) from at most ``rows`` documents with a known lang."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .select("doc_id", "lang").orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(rows)
    known = known.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    s = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("lang", "text")

    def task(batches):
        for b in batches:
            lang = np.array(b.column(0).to_pylist(), object)
            total: dict[str, np.ndarray] = {}
            for lo, hi, data, off in blocks(b.column(1)):
                c = _cells(data, off)
                for i in range(lo, hi):
                    n = np.bincount(c[off[i - lo]:off[i - lo + 1]], minlength=CELLS + 1)
                    total[lang[i]] = total.get(lang[i], 0) + n
            for k, n in total.items():
                cell = np.flatnonzero(n[:CELLS])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(cell), pa.string()), pa.array(cell.astype(np.int32)),
                     pa.array(n[cell].astype(np.int64))], ["lang", "cell", "n"])

    # at most CELLS rows per language
    got = s.mapInArrow(task, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")) \
        .toPandas()
    langs = sorted(got["lang"].unique())
    counts = np.zeros((len(langs), CELLS))
    for k, name in enumerate(langs):
        mine = got[got["lang"] == name]
        counts[k, mine["cell"].to_numpy()] = mine["n"].to_numpy()
    pool = counts.sum(0) + 0.5
    pool /= pool.sum() or 1
    table = np.log((counts + 50 * pool) / (counts.sum(1, keepdims=True) + 50)) if langs else np.zeros((0, CELLS))
    return langs, np.concatenate([table, np.zeros((len(langs), 1))], 1)


def text_evidence(df: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """Adds ``ev`` (log likelihood of each language, best at 0; flat under 3 bytes, null if empty)."""
    shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table.T))  # CELLS x languages
    names = [c for c in df.columns if c != "text"]

    def task(batches):
        per_lang = np.ascontiguousarray(shared.value.T)
        for b in batches:
            at = b.schema.get_field_index("text")
            ev: list = []
            for _, _, data, off in blocks(b.column(at)):
                c = _cells(data, off)
                used = np.concatenate(([0], np.cumsum(c < CELLS)))
                n = used[off[1:]] - used[off[:-1]]
                ll = np.empty((len(n), len(per_lang)))
                for k, t in enumerate(per_lang):
                    s = np.concatenate(([0.0], np.cumsum(t[c])))
                    ll[:, k] = s[off[1:]] - s[off[:-1]]
                ll -= ll.max(1, keepdims=True)
                ll *= np.minimum(1.0, TEXT_WEIGHT / np.maximum(n, 1))[:, None]
                ev += [list(x) if m else None for x, m in zip(ll, off[1:] > off[:-1], strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(x)) for x in names),
                                              pa.array(ev, pa.list_(pa.float64()))], [*names, "ev"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "text")
    return df.mapInArrow(task, f"{schema}, ev array<double>")


def _posterior(logs: Column) -> Column:
    e = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def _mass(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Summed text posterior of each language per key."""
    return df.groupBy(*keys).agg(F.array(*[F.sum(F.col("post")[i]) for i in range(k)]).alias("mass"))


def _smoothed(mass: Column, parent: Column) -> Column:
    total = F.aggregate(mass, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(mass, parent, lambda m, p: (m + STRENGTH * p) / (total + STRENGTH))


def identify(df: DataFrame, langs: list[str], table: np.ndarray, accept_at: float = 0.5) -> DataFrame:
    """``df`` (row_id, text, declared, suffix, host) -> row_id, lang, posterior, accepted."""
    k = len(langs)
    cols = df.select(F.col("row_id").cast("long").alias("row_id"), "text", *[
        F.nullif(F.lower(F.trim(F.col(c).cast("string"))), F.lit("")).alias(c) for c in ("declared", "suffix", "host")])
    if not k:
        return cols.select("row_id", F.lit("und").alias("lang"), F.lit(0.0).alias("posterior"),
                           F.lit(False).alias("accepted"))
    ev = persist(text_evidence(cols, langs, table), "langs")
    ev = ev.withColumn("parent", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1))
    seen = ev.where("ev is not null").withColumn("post", _posterior(F.col("ev")))
    # hosts -> parents -> global: each level is summed from the level below
    hosts = persist(_mass(seen.where("host is not null"), ["host", "parent"], k), "hosts")
    up = lambda d, keys: d.groupBy(*keys).agg(
        F.array(*[F.sum(F.col("mass")[i]) for i in range(k)]).alias("mass"))
    whole = _mass(seen, [], k).select(F.coalesce("mass", F.array(*[F.lit(0.0)] * k)).alias("g"))
    whole = whole.select(F.transform("g", lambda x: F.coalesce(x, F.lit(0.0))).alias("g"))
    share = whole.select(_smoothed(F.col("g"), F.array(*[F.lit(1.0 / k)] * k)).alias("share"))
    parents = up(hosts, ["parent"]).crossJoin(F.broadcast(share)).select(  # share is one row
        "parent", _smoothed(F.col("mass"), F.col("share")).alias("p"))
    prior = hosts.join(parents, "parent").select("host", _smoothed(F.col("mass"), F.col("p")).alias("prior"))

    def value_table(name: str) -> DataFrame:
        m = persist(_mass(seen.where(F.col(name).isNotNull()), [name], k), name)
        total = up(m, []).select(F.col("mass").alias("t"))
        n = m.agg(F.count(F.lit(1)).alias("n"))
        return m.crossJoin(F.broadcast(total)).crossJoin(F.broadcast(n)).select(  # one row each
            name, F.zip_with("mass", "t", lambda x, t: F.log((x + 1.0) / (t + F.col("n")))).alias(name + "_ev"))

    out = ev.join(prior, "host", "left").crossJoin(F.broadcast(share))
    zero = F.array(*[F.lit(0.0)] * k)
    logs = F.zip_with(F.coalesce("ev", zero), F.coalesce("prior", "share"), lambda a, p: a + F.log(p))
    for name in ("declared", "suffix"):
        out = out.join(value_table(name), name, "left")
        logs = F.zip_with(logs, F.coalesce(F.col(name + "_ev"), zero), lambda a, b: a + b)
    out = out.withColumn("post", _posterior(logs))
    best = F.array_max("post")
    some = F.col("ev").isNotNull() | F.col("declared").isNotNull() | F.col("suffix").isNotNull() \
        | F.col("prior").isNotNull()
    named = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("post", best).cast("int"))
    return out.select("row_id", F.when(some, named).otherwise("und").alias("lang"),
                      F.when(some, best).otherwise(0.0).alias("posterior"),
                      (some & (best >= accept_at) & (F.col("ev").isNotNull() | (best >= 0.9))).alias("accepted"))


def of_documents(docs: DataFrame) -> DataFrame:
    """``documents`` as evidence: the source is the host, there is no markup and no address."""
    none = F.lit(None).cast("string")
    return docs.select(F.col("doc_id").alias("row_id"), "text", none.alias("declared"), none.alias("suffix"),
                       F.col("source").alias("host"))


def of_pages(pages: DataFrame) -> DataFrame:
    """``pages`` as evidence: text without tags, <html lang>, last label and whole host of the URL."""
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), "<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    declared = F.regexp_extract("html", r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([a-zA-Z]{2,3})""", 1)
    return pages.select(F.col("page_id").alias("row_id"), text.alias("text"), declared.alias("declared"),
                        F.regexp_extract(host, r"\.([a-z]+)$", 1).alias("suffix"), host.alias("host"))


def accepted(docs: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """The rows of ``docs`` (documents) whose language is accepted, all columns, with ``lang`` the
    language identified. A row is known by the hash of its id, text and source, by which the rows that go
    or change are joined back."""
    key = F.xxhash64("doc_id", "text", "source")
    verdict = identify(of_documents(docs).withColumn("row_id", F.xxhash64("row_id", "text", "host")), langs, table)
    said = docs.select(key.alias("row_id"), F.col("lang").alias("said"))
    other = verdict.join(said, "row_id").where(~(F.col("accepted") & F.col("lang").eqNullSafe(F.col("said")))).select(
        F.col("row_id").alias("_row"), F.when(F.col("accepted"), F.col("lang")).alias("_lang")).distinct()
    rows = docs.join(bounded(persist(other, "relabelled")), key == F.col("_row"), "left")
    rows = rows.where("_row is null or _lang is not null").withColumn("lang", F.coalesce("_lang", "lang"))
    return rows.drop("_row", "_lang")
