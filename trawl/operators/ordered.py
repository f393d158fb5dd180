"""Skew-safe ordered operators: positions within a key, top-k per key, running sums.

A plain ``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a key to one
task; with one host, queue or label holding a third of all rows that task holds a third of the
data. These helpers keep the exact semantics but split hot keys:

* ``position_within``: rows are cut into ordered buckets by bounds over (key, order) that are
  computed once, as values; a row's bucket is an expression of the row alone, so every side of the
  plan and every retry agrees on it. Rows are numbered inside (key, bucket), and the counts of the
  key's earlier buckets are added from a small (key, bucket) table; the numbering and the join use
  the same hash partitioning, so the rows are shuffled once.
* ``top_k_per_key``: exact top-k from per-(key, salt) top-k candidates, then a final top-k over
  at most ``salts * k`` rows per key.
* ``running_sums``: the same buckets over the order alone; sums inside a bucket plus the totals of
  earlier buckets (one row per bucket, broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Buckets up to which a row is compared with every bound; beyond, with a list of lists of bounds.
FLAT = 64


def _bucketed(df: DataFrame, cols: list[str], num: int | None) -> DataFrame:
    """``df`` with ``_b``: the number of bounds at or below the row's ``cols``, an ordered, deterministic
    bucket. As many buckets as shuffle partitions (or ``num``), which follow the size of the data.

    The bounds are quantiles of the ``32 * num`` rows with the smallest hash of ``cols`` (one
    bounded top-k job), so they are the same for any partitioning of the input. Many bounds are one
    row of lists, joined to all rows: the first bounds of the lists tell the list, the list the bucket, so
    a row is compared with about twice the square root of their number."""
    num = max(1, num or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    keys = df.select(*cols)
    picked = sorted(
        keys.orderBy(F.xxhash64(*cols)).limit(32 * num).collect(),
        key=lambda r: [(v is not None, v if v is not None else 0) for v in r])
    step = len(picked) / num
    bounds = [picked[int(i * step)] for i in range(1, num)] if step >= 1 else picked[1:]
    here = F.struct(*[F.col(c) for c in cols])
    below = lambda xs: F.size(F.filter(xs, lambda x: x <= here))
    if len(bounds) <= FLAT:
        types = [f.dataType for f in keys.schema.fields]
        row = lambda r: F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(r, types, cols, strict=True)])
        return df.withColumn("_b", below(F.array(*[row(r) for r in bounds])) if bounds else F.lit(0))
    width = int(len(bounds) ** 0.5)
    lists = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    item = T.StructType([T.StructField(f.name, f.dataType) for f in keys.schema.fields])
    schema = T.StructType([T.StructField("_first", T.ArrayType(item)), T.StructField("_lists", T.ArrayType(T.ArrayType(item)))])
    table = df.sparkSession.createDataFrame([([x[0] for x in lists[1:]], lists)], schema)
    found = df.crossJoin(F.broadcast(table)).withColumn("_list", below(F.col("_first")))  # one row
    return found.withColumn("_b", F.col("_list") * width + below(F.element_at("_lists", F.col("_list") + 1))) \
        .drop("_first", "_lists", "_list")


def position_within(df: DataFrame, keys: list[str], order: list[str], out: str = "pos",
                    num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its ``keys`` group by ``order`` (``order`` must be a
    total order within a key, e.g. end with a unique column). Null keys form a group."""
    tagged = _bucketed(df, keys + order, num_partitions)
    here = Window.partitionBy(*keys, "_b")
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    side = tagged.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    side = side.select(*[F.col(k).alias("_k_" + k) for k in keys], F.col("_b").alias("_k_b"),
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ranked = tagged.withColumn("_r", F.row_number().over(here.orderBy(*order)))
    same = F.col("_b") == F.col("_k_b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_k_" + k))
    joined = ranked.join(side, same)
    return joined.withColumn(out, (F.col("_off") + F.col("_r")).cast("long")) \
        .drop("_b", "_r", "_off", "_k_b", *["_k_" + k for k in keys])


def top_k_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, salts: int = 16,
                  salt_col: str | None = None) -> DataFrame:
    """Exact top-``k`` rows per key by ``order`` with hot keys split over ``salts`` sub-groups.

    ``salt_col`` (a column that spreads rows, e.g. the URL) defaults to a hash of all columns.
    Adds ``rank`` (1..k).
    """
    salt_src = F.col(salt_col) if salt_col else F.struct(*[F.col(c) for c in df.columns])
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_src), F.lit(salts)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    cand = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return cand.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)


def running_sums(df: DataFrame, order: list[str], values: list[str], prefix: str = "cum_",
                 num_partitions: int | None = None) -> DataFrame:
    """Cumulative sums of ``values`` over the total order ``order`` (rows unbounded preceding to
    current row), without collecting the data into one partition. Nulls add nothing."""
    tagged = _bucketed(df, order, num_partitions)
    here = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    value = {v: F.coalesce(F.col(v).cast("double"), F.lit(0.0)) for v in values}
    totals = tagged.groupBy("_b").agg(*[F.sum(value[v]).alias("_t_" + v) for v in values])
    offsets = totals.select("_b", *[F.coalesce(F.sum("_t_" + v).over(before), F.lit(0.0)).alias("_o_" + v)
                                    for v in values])
    local = tagged.withColumns({prefix + v: F.sum(value[v]).over(here) for v in values})
    out = local.join(F.broadcast(offsets), "_b")  # one row per bucket: as many as shuffle partitions
    return out.withColumns({prefix + v: F.col(prefix + v) + F.col("_o_" + v) for v in values}) \
        .drop("_b", *["_o_" + v for v in values])
