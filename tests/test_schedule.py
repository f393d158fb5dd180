"""Schedulers and delays: quality-weighted delay (C6), score-based intervals, relevance to
seconds (C7), crawl delay rule, segments (C7)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trawl.functions import schedule as S

W = {"isCurlieDomain": 0.0, "isWikipediaWeblinkDomain": -0.5, "isClueWebDomain": 0.3}


def md(*flags):
    return {f: ["true"] for f in flags}


@pytest.mark.parametrize("flags,base,minutes", [
    ((), -1, -1), (("isCurlieDomain",), 5, 5),
    (("isCurlieDomain", "isWikipediaWeblinkDomain", "isClueWebDomain"), 5, 6),
    (("isCurlieDomain", "isClueWebDomain"), 10, 7),
])
def test_quality_delay(spark, flags, base, minutes):
    df = spark.createDataFrame([(md(*flags), base)], "md map<string,array<string>>, base int")
    assert df.select(S.quality_delay(F.col("md"), F.col("base"), W).alias("m")).first().m == minutes


def test_false_flag_is_ignored(spark):
    df = spark.createDataFrame([({"isClueWebDomain": ["false"]}, 10)], "md map<string,array<string>>, base int")
    assert df.select(S.quality_delay(F.col("md"), F.col("base"), W).alias("m")).first().m == 10


def test_score_scheduler_intervals(spark):
    now = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(s,) for s in ("FETCHED", "DISCOVERED", "ERROR", "FETCH_ERROR", "REDIRECTION")]
    df = spark.createDataFrame(rows, "status string")
    out = df.select("status", S.schedule_score(F.col("status"), F.create_map().cast("map<string,array<string>>"),
                                               F.lit(now)).alias("nf")).collect()
    mins = {r.status: (r.nf - now).total_seconds() / 60 for r in out}
    assert mins == {"FETCHED": 1440, "DISCOVERED": 0, "ERROR": 44640, "FETCH_ERROR": 120, "REDIRECTION": 1440}


def test_focused_scheduler(spark):
    now = dt.datetime(2024, 1, 1, 0, 0)
    rows = [("FETCHED", None), ("DISCOVERED", "1970-01-06T18:53:21Z"), ("DISCOVERED", None), ("FETCH_ERROR", None)]
    df = spark.createDataFrame(rows, "status string, d string")
    mdc = F.when(F.col("d").isNotNull(), F.create_map(F.lit("status.store.as.is.with.nextfetchdate"), F.array("d")))
    out = [r.nf for r in df.select(S.schedule_focused(F.col("status"), mdc, F.lit(now)).alias("nf")).collect()]
    assert out[0] is None and out[2] is None
    assert out[1] == dt.datetime(1970, 1, 6, 18, 53)
    assert out[3] == now + dt.timedelta(minutes=120)


@pytest.mark.parametrize("rel,seconds", [(-1, 1000000), (0, 500001), (0.5, 250001), (1, 1), (1.3, -149999)])
def test_relevance_seconds(spark, rel, seconds):
    assert spark.range(1).select(S.relevance_seconds(F.lit(float(rel))).alias("s")).first().s == seconds


def test_relevance_monotone(spark):
    df = spark.range(-20, 21).select((F.col("id") / 10.0).alias("r"))
    vals = [r.s for r in df.orderBy("r").select(S.relevance_seconds(F.col("r")).alias("s")).collect()]
    assert all(a >= b for a, b in zip(vals, vals[1:]))


def test_crawl_delay_rule(spark):
    df = spark.createDataFrame([(None,), (0.5,), (10.0,), (45.0,)], "d double")
    refused = [r.x for r in df.select(S.crawl_delay(F.col("d")).alias("x")).collect()]
    forced = [r.x for r in df.select(S.crawl_delay(F.col("d"), force_max=True, force_default=True).alias("x")).collect()]
    assert refused == [1.0, 0.5, 10.0, None]
    assert forced == [1.0, 1.0, 10.0, 30.0]
