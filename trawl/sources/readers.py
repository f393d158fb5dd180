"""Readers (S3-S15). All of them are Spark readers with explicit schemas; nothing is read on
the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl import schemas
from trawl.operators.graph import read_graph_json
from trawl.operators.lookup import read_denylist, read_keys, read_labels  # noqa: F401  (S6-S8)
from trawl.operators.warc import read_warc  # noqa: F401  (S4)


def read_seeds(spark: SparkSession, path: str, discovered: bool = True, stream: bool = False) -> DataFrame:
    """S3: one URL per line, trimmed, blank lines dropped, optionally tagged DISCOVERED."""
    src = spark.readStream.format("text").load(path) if stream else spark.read.text(path)
    out = src.select(F.trim("value").alias("url")).filter(F.col("url") != "")
    if discovered:
        out = out.withColumn("status", F.lit("DISCOVERED"))
    return out


def prefix_paths(paths: DataFrame, prefix: str, col: str = "value") -> DataFrame:
    """Prepend a base location to every archive path."""
    return paths.select(F.concat(F.lit(prefix), F.col(col)).alias("path"))


def read_corpus(spark: SparkSession, path: str, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Corpus vectors from Parquet; a singleton middle axis (array of one-element arrays) is squeezed."""
    df = spark.read.parquet(path)
    t = dict(df.dtypes)[vec_col]
    v = F.flatten(F.col(vec_col)) if t.startswith("array<array") else F.col(vec_col)
    return df.select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))


def read_vector_text(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated doubles, first line of each file."""
    lines = spark.read.text(path).withColumn("_file", F.input_file_name()) \
        .withColumn("_n", F.monotonically_increasing_id())
    first = lines.groupBy("_file").agg(F.min_by("value", "_n").alias("value"))
    return first.select(F.col("_file").alias("path"), F.transform(
        F.filter(F.split(F.trim("value"), r"\s+"), lambda x: x != ""), lambda x: x.cast("double")).alias("vector"))


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """S11: 'token id' per line."""
    return spark.read.csv(path, sep=" ", schema="token string, id int")


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """One target URL per line."""
    return spark.read.text(path).select(F.trim("value").alias("url")).filter(F.col("url") != "")


def read_graph(spark: SparkSession, path: str) -> DataFrame:
    """JSON adjacency lines {src: [dst, ...]} -> (src, dst)."""
    return read_graph_json(spark.read.text(path))


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """Sitemap documents -> (url, last_modified) with the built-in XML source."""
    df = spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string").load(path)
    return df.select(F.trim("loc").alias("url"), F.try_to_timestamp(F.trim("lastmod")).alias("last_modified"),
                     F.create_map(F.lit("sitemap.lastModified"), F.array(F.trim("lastmod"))).alias("metadata"))


def read_index(spark: SparkSession, path: str, which: str) -> DataFrame:
    """Status / content / metrics table with its fixed schema."""
    return spark.read.schema(schemas.INDEX_TABLES[which]).parquet(path)
