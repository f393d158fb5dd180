"""Skew-safe ordered helpers equal the plain window functions, on data with one hot key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trawl.operators.ordered import position_within, running_sums, top_k_per_key


def skewed(spark, n=3000):
    # key 'hot' holds a third of all rows
    return spark.range(n).select(F.col("id").alias("uid"),
                                 F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 37).cast("string"))).alias("key"),
                                 ((F.col("id") * 7919) % 1000).alias("v"))


def test_position_within(spark):
    df = skewed(spark)
    got = position_within(df, ["key"], ["v", "uid"], num_partitions=7)
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("key").orderBy("v", "uid")))
    assert sorted(got.select("uid", "pos").collect()) == sorted(exp.select("uid", "pos").collect())


def test_global_position(spark):
    df = skewed(spark, 500)
    got = position_within(df, [], ["v", "uid"], num_partitions=5)
    exp = df.withColumn("pos", F.row_number().over(Window.orderBy("v", "uid")))
    assert sorted(got.select("uid", "pos").collect()) == sorted(exp.select("uid", "pos").collect())


def test_top_k(spark):
    df = skewed(spark)
    got = top_k_per_key(df, ["key"], [F.col("v").desc(), F.col("uid")], 3, salt_col="uid")
    exp = df.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(F.col("v").desc(), "uid"))) \
        .filter("rank <= 3")
    assert sorted(got.select("uid", "rank").collect()) == sorted(exp.select("uid", "rank").collect())


def test_running_sums(spark):
    df = skewed(spark, 1000).withColumn("x", F.col("v") / 10.0)
    got = running_sums(df, ["uid"], ["x"], num_partitions=6).select("uid", "cum_x").toPandas().sort_values("uid")
    exp = df.withColumn("c", F.sum("x").over(Window.orderBy("uid").rowsBetween(Window.unboundedPreceding, 0))) \
        .toPandas().sort_values("uid")
    assert (abs(got.cum_x.to_numpy() - exp.c.to_numpy()) < 1e-6).all()


def test_hot_key_spans_several_tasks(spark):
    """The hot key (a third of the rows) is spread over several range partitions, not one task."""
    df = skewed(spark, 3000)
    n = 6
    cols = [F.col("key"), F.col("v"), F.col("uid")]
    parts = df.repartitionByRange(n, *cols).withColumn("_pid", F.spark_partition_id()) \
        .filter(F.col("key") == "hot").select("_pid").distinct().count()
    assert parts >= 2


def test_large_with_extra_columns_and_a_hot_key(spark):
    """A million rows, more columns kept than key and order, one key with two thirds of the rows."""
    n = 1_000_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        F.xxhash64("id").alias("ord"), F.col("id").alias("row"), (F.col("id") % 11).cast("double").alias("v"))
    got = position_within(df, ["key"], ["ord", "row"], "pos", 64)
    w = Window.partitionBy("key").orderBy("ord", "row")
    bad = got.withColumn("want", F.row_number().over(w)).where("pos != want").count()
    assert (got.count(), bad) == (n, 0)
    got = running_sums(df, ["ord", "row"], ["v"], num_partitions=64)
    w = Window.orderBy("ord", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    assert got.withColumn("want", F.sum("v").over(w)).where("cum_v != want").count() == 0


def test_position_with_null_keys_and_order(spark):
    df = spark.createDataFrame([(None, 3), (None, None), ("a", 2), ("a", 1)], "k string, o int")
    got = {(r.k, r.o): r.pos for r in position_within(df, ["k"], ["o"]).collect()}
    assert got == {(None, None): 1, (None, 3): 2, ("a", 1): 1, ("a", 2): 2}


def test_many_buckets(spark):
    """More bounds than a row is compared with one by one; nulls, ties before the last column, a hot key."""
    df = skewed(spark, 20_000).withColumn("v", F.when(F.col("v") % 50 != 0, F.col("v")))
    got = position_within(df, ["key"], ["v", "uid"], num_partitions=500)
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("key").orderBy("v", "uid")))
    assert got.select("uid", "pos").exceptAll(exp.select("uid", "pos")).count() == 0 and got.count() == 20_000
    from trawl.operators.ordered import _bucketed
    sizes = [r["count"] for r in _bucketed(df, ["key", "v", "uid"], 500).groupBy("_b").count().collect()]
    assert len(sizes) > 450 and max(sizes) < 400
    sums = running_sums(df.withColumn("x", F.lit(1.0)), ["uid"], ["x"], num_partitions=300)
    assert sums.where(F.col("cum_x") != F.col("uid") + 1).count() == 0
