"""Written tables that cut lineage, in the shared folder the session names in
``spark.checkpoint.dir`` (a private one is set only where it is unset and the master is local)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import configure, ensure_checkpoint_dir, load_table

#: Ids of a list that may be broadcast (8 bytes each: 16 MB).
BROADCAST_IDS = 2_000_000


def persist(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder of the shared checkpoint directory and read it
    back: a lost executor then costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/trawl-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def persist_alone(df: DataFrame, name: str) -> DataFrame:
    """As ``persist``; the shuffle files of the query that made ``df`` go when it is written, so that
    steps one after another don't add up on the executors' disks."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return persist(df, name)
    finally:
        conf.set(key, was)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, spread over the cores where its scan has fewer splits."""
    configure(spark)
    return load_table(spark, sf_dir, name, spread=True)


def bounded(ids: DataFrame) -> DataFrame:
    """A written list of ids: broadcast if it is short enough, joined by a shuffle otherwise."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
