"""Bounded samples of labelled rows, the same for any partitioning of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text modulo 5 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int, held_out: int | None) -> DataFrame:
    """(doc_id, text, y): at most ``rows`` labelled documents, those with the smallest hash of the
    id, without fold ``held_out``. The ids are a bounded list, so the join broadcasts them."""
    l = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if held_out is not None:
        l = l.where(fold() != held_out)
    l = l.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    l = l.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").join(F.broadcast(l), "doc_id") \
        .selectExpr("doc_id", "text", "y")
