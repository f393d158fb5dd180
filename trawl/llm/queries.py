"""The operators with production parameters over their whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trawl.llm import align, boosted, bwt_dedup, concat_cut, ftrl, fusion, heap_bpe, lsh_forest, merge_replay, merkle, projected_search, suffix_tree, warc_history
from trawl.llm.store import load

JSON_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANK_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scores(load(spark, sf_dir, "documents"))


def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(load(spark, sf_dir, "documents"))


def op3_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.dedup(load(spark, sf_dir, "documents"))


def op4_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, lang, posterior, kept."""
    docs = load(spark, sf_dir, "documents")
    got = fusion.identify(fusion.of_documents(docs), *fusion.trigram_tables(docs))
    return got.selectExpr("row_id as doc_id", "lang", "posterior", "accepted as kept")


def page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over ``pages``, with declared language, address suffix and host."""
    tables = fusion.trigram_tables(load(spark, sf_dir, "documents"))
    got = fusion.identify(fusion.of_pages(load(spark, sf_dir, "pages")), *tables)
    return got.selectExpr("row_id as page_id", "lang", "posterior", "accepted as kept")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_bpe.token_counts(load(spark, sf_dir, "documents"), JSON_BPE, public_tokenizers.PATTERN)


def op6_boosted_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return boosted.quality(docs, boosted.fit(docs, load(spark, sf_dir, "labels")))


def op7_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat_cut.pack(load(spark, sf_dir, "documents"), JSON_BPE, public_tokenizers.PATTERN)


def op8_projected_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_search.nearest(load(spark, sf_dir, "embeddings"))


def op9_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return ftrl.scored(docs, ftrl.fit(docs, load(spark, sf_dir, "labels")))


def op10_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_replay.digests(load(spark, sf_dir, "documents"), RANK_BPE, public_tokenizers.PATTERN)


def op11_incremental_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(load(spark, sf_dir, "documents"))


def op12_merged_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_history.digests(load(spark, sf_dir, "pages"))


def op13_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(load(spark, sf_dir, "documents"), JSON_BPE, public_tokenizers.PATTERN, PIECES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return out | {"page_language": page_language}


def oracle_sql() -> dict[str, str]:
    return {"op11_incremental_merkle": merkle.ORACLE_SQL, "op12_merged_captures": warc_history.ORACLE_SQL}
