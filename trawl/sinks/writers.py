"""Writers (K1, K2, K5, K7-K12). Every writer is a DataFrame write; text sinks are built
with column expressions first, so the only per-row Python is the archive byte framing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl import schemas
from trawl.operators.embed import vector_text
from trawl.operators.frontier import status_log_line
from trawl.operators.graph import graph_json
from trawl.operators.warc import write_warc  # noqa: F401  (K1, K2)


def write_status_log(status: DataFrame, path: str, now, key_col: str = "key") -> None:
    """K5: one formatted line per status row."""
    line = status_log_line(now, F.col("status"), F.col("next_fetch"), F.col("url"),
                           F.col(key_col) if key_col in status.columns else F.lit(None), F.col("metadata"))
    status.select(line.alias("value")).write.mode("append").text(path)


def write_graph(edges: DataFrame, path: str, src: str = "src", dst: str = "dst") -> None:
    """K7: adjacency by source as JSON lines."""
    graph_json(edges, src, dst).select(F.col("json").alias("value")).write.mode("overwrite").text(path)


EVAL_FIELDS = ["url", "is_relevant", "cum_relevant", "cum_total", "harvest_rate", "info_sum", "cum_time",
               "recall", "path_depth", "processing_time"]


def write_evaluation_log(evaluated: DataFrame, path: str, fields=EVAL_FIELDS) -> None:
    """K8: labelled lines per page (one record of up to 10 lines), appended."""
    present = [f for f in fields if f in evaluated.columns]
    rec = F.concat_ws("\n", *[F.concat(F.lit(f + ": "), F.col(f).cast("string")) for f in present])
    evaluated.select(rec.alias("value")).write.mode("append").text(path)


def page_debug_report(scores: DataFrame, seg_stats: DataFrame, page_stats: DataFrame, page_col: str = "page",
                      text_col: str | None = None) -> DataFrame:
    """K9: per block 'pred: p score: s text', per segment pct/sum/mean/var, page totals, as
    (page, kind, idx, line) rows in order (no per-page list is collected)."""
    blk = scores.select(page_col, F.lit(0).alias("kind"), F.col("block_idx").alias("idx"), F.format_string(
        "pred: %d score: %.6f %s", F.col("pred"), F.col("score"),
        F.col(text_col) if text_col else F.lit("")).alias("line"))
    seg = seg_stats.select(page_col, F.lit(1).alias("kind"), F.col("segment").cast("long").alias("idx"), F.format_string(
        "segment %d pct: %s sum: %s mean: %s var: %s", F.col("segment"), F.col("seg_relevant_pct").cast("string"),
        F.col("seg_sum").cast("string"), F.col("seg_mean").cast("string"), F.col("seg_var").cast("string")).alias("line"))
    tot = page_stats.select(page_col, F.lit(2).alias("kind"), F.lit(0).cast("long").alias("idx"), F.format_string(
        "blocks: %d relevant: %d pct: %.6f sum: %.6f mean: %.6f var: %.6f", F.col("num_blocks"), F.col("num_relevant"),
        F.col("relevant_pct"), F.col("score_sum"), F.col("score_mean"), F.col("score_var")).alias("line"))
    return blk.unionByName(seg).unionByName(tot)


def write_vectors(df: DataFrame, path: str, vec_col: str = "embedding", key_col: str = "url") -> None:
    """Doubles joined by spaces."""
    df.select(F.concat_ws("\t", F.col(key_col).cast("string"), vector_text(vec_col)).alias("value")) \
        .write.mode("overwrite").text(path)


def null_sink(df: DataFrame) -> None:
    """Evaluate everything, store nothing."""
    df.write.format("noop").mode("overwrite").save()


def console_sink(df: DataFrame, n: int = 20) -> None:
    """Print to stdout."""
    df.show(n, truncate=False)


def create_index_tables(spark: SparkSession, base: str) -> dict[str, str]:
    """(re)create the status, content and metrics tables with their fixed schemas."""
    out = {}
    for name, schema in schemas.INDEX_TABLES.items():
        p = f"{base.rstrip('/')}/{name}"
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(p)
        out[name] = p
    return out
