"""Corpus pipeline: quality classifier, language identification, near duplicates, repeated
passages, packing. Each stage works on all rows its predecessor kept; all but the last return the
columns of ``documents``.

Rows with the same id are told apart by their text where a stage joins its verdicts back. Other columns
than those of ``documents`` are dropped by the first stage; an empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import bwt_dedup, concat_cut, ftrl, fusion, lsh_forest
from trawl.llm.store import bounded, load, persist

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier accepts (score 0.3 or more); a null text is scored
    as an empty one."""
    weights = ftrl.fit(docs, load(spark, sf_dir, "labels"))
    return ftrl.accepted(docs, weights).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is identified, and writes it to ``lang``. An empty text without
    other evidence has no language and goes; a null or other ``lang`` is replaced."""
    return fusion.accepted(docs, *fusion.trigram_tables(docs)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id. Of rows that share
    an id, one stays: the one whose text hashes smallest. Rows without an id all stay."""
    verdict = persist(lsh_forest.near_duplicates(docs), "verdicts").where("doc_id is not null")
    gone = persist(verdict.where(~F.col("kept")).select("doc_id").distinct(), "copies")
    twice = persist(verdict.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    kept = docs.select(*COLUMNS).join(bounded(gone), "doc_id", "left_anti")
    one = F.min_by(F.struct(*COLUMNS), F.struct(F.xxhash64("text"), "text", "lang", "source", "n_chars")).alias("row")
    several = kept.join(bounded(twice), "doc_id", "left_semi").groupBy("doc_id").agg(one).select("row.*")
    return kept.join(bounded(twice), "doc_id", "left_anti").unionByName(several)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages from the texts; a text that is left empty stays as empty."""
    kept = bwt_dedup.cleaned(docs, list(COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into sequences of 1024 tokens."""
    return concat_cut.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("suffix_array_dedup", passages),
    ("packing", packing),
]

ORACLE_SQL = None  # learnt and hashed stages: tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = persist(docs, name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
