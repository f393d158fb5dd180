"""Session helpers: session construction, checkpoint directory, table loading, size-checked broadcast."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Rows above which a side is never broadcast, whatever the optimizer estimates.
DEFAULT_BROADCAST_ROWS = 2_000_000


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "trawl") -> SparkSession:
    """Session with the settings every operator assumes (UTC, AQE, LAST_WIN map keys, no UI)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators rely on to an existing session, and make the
    package importable in the Python workers (Arrow UDFs refer to its helpers)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Local runs: zip this package once per SparkContext and ``addPyFile`` it, so Python workers
    started from any directory can import it. Cluster jobs ship it with ``--py-files``."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED or not sc.master.startswith("local"):
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="trawl-pkg-")
    path = os.path.join(out_dir, "trawl.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint directory for lineage cuts.

    On a cluster the shared folder is named by ``spark.checkpoint.dir``; it is read from the
    session. Only when nothing is configured and the master is local (tests, laptop runs) a
    private folder under the system temp dir is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if sc.master.startswith("local"):
        local_dir = tempfile.mkdtemp(prefix="trawl-ckpt-")
        sc.setCheckpointDir(local_dir)
        return local_dir
    raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")


# Tables whose rows carry whole documents: per-row work (regex parsing, segmentation,
# tokenising) dominates, so they are worth spreading before that work starts.
TEXT_TABLES = frozenset({"pages", "documents"})


def load_table(spark: SparkSession, sf_dir: str, name: str, spread: bool | None = None) -> DataFrame:
    """Parquet table; when its scan has fewer splits than the cluster has cores (a small table
    stored as one row group), rows are hash-spread over the cores first.

    Parsing, segmentation and scoring are CPU-heavy per row, so a one-split scan would run them
    in one task. At scale the scan already has many more splits than cores and nothing changes.
    The spread is an explicit-count repartition, so AQE keeps all of its partitions.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if spread is None:
        spread = name in TEXT_TABLES
    if spread:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores, df.columns[0])
    return df


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only after checking its row count against a hard bound.

    The count is one cheap aggregate over an already small side (lookup lists, corpora,
    per-partition offsets). Above the bound the caller's shuffle join is used instead.
    """
    n = df.count()
    if n <= max_rows:
        return F.broadcast(df), True
    return df, False
