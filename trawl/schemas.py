"""Explicit schemas of the data model (D1-D20); no inference anywhere."""

from __future__ import annotations

from pyspark.sql import types as T

MD = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

# D1 fetched page, D2 parsed page
PAGE = T.StructType([T.StructField("url", T.StringType()), T.StructField("content", T.BinaryType()),
                     T.StructField("metadata", MD)])
PARSED_PAGE = T.StructType(PAGE.fields + [T.StructField("text", T.StringType())])

# D4 status stream
STATUS = T.StructType([T.StructField("url", T.StringType()), T.StructField("metadata", MD),
                       T.StructField("status", T.StringType())])

# D7 normalised: blocks
BLOCKS = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("block_idx", T.LongType()),
    T.StructField("text", T.StringType()), T.StructField("is_content", T.BooleanType()),
    T.StructField("links", T.ArrayType(T.StringType())),
    T.StructField("embedding", T.ArrayType(T.DoubleType()))])

# D8 page statistics
SEGMENT = T.StructType([T.StructField("idx", T.IntegerType()), T.StructField("sum", T.DoubleType()),
                        T.StructField("mean", T.DoubleType()), T.StructField("var", T.DoubleType()),
                        T.StructField("pct", T.DoubleType())])
PAGE_STATS = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("num_segments", T.IntegerType()),
    T.StructField("num_blocks", T.IntegerType()), T.StructField("num_relevant", T.IntegerType()),
    T.StructField("lof_mean", T.DoubleType()), T.StructField("lof_sum", T.DoubleType()),
    T.StructField("lof_var", T.DoubleType()), T.StructField("relevant_pct", T.DoubleType()),
    T.StructField("segments", T.ArrayType(SEGMENT))])

# D9 graph
EDGES = T.StructType([T.StructField("src", T.StringType()), T.StructField("dst", T.StringType())])
SCORES = T.StructType([T.StructField("node", T.StringType()), T.StructField("hub", T.DoubleType()),
                       T.StructField("authority", T.DoubleType())])

# D10 frontier
FRONTIER = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("key", T.StringType()), T.StructField("metadata", MD),
    T.StructField("status", T.StringType()), T.StructField("next_fetch", T.TimestampType()),
    T.StructField("leased_until", T.TimestampType())])

# D11 status index
STATUS_INDEX = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("next_fetch_date", T.TimestampType()),
    T.StructField("status", T.StringType()), T.StructField("url", T.StringType()), T.StructField("metadata", MD)])

# D12 content index
CONTENT_INDEX = T.StructType([T.StructField(n, T.StringType()) for n in (
    "content", "host", "title", "url", "keywords", "description")] + [
    T.StructField("publicationdate", T.TimestampType())] + [T.StructField(n, T.StringType()) for n in (
        "sitename", "pagetype", "favicon", "pageimage", "feedlink")] + [T.StructField("capturetime", T.TimestampType())])

# D13 metrics
METRICS = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("task_id", T.ShortType()),
    T.StructField("component", T.StringType()), T.StructField("worker", T.StringType()),
    T.StructField("port", T.IntegerType()), T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType())])

# D14 corpus, D20 archive record
CORPUS = T.StructType([T.StructField("vec_id", T.LongType()),
                       T.StructField("embedding", T.ArrayType(T.FloatType()))])
WARC_RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("payload", T.BinaryType())])

INDEX_TABLES = {"status": STATUS_INDEX, "content": CONTENT_INDEX, "metrics": METRICS}
