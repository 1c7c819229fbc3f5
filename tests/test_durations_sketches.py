"""Durations from text against pandas, quantile sketches against true ranks, sparse one-hot vectors."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from framewise.functions.dates import micros_of, to_timedelta
from framewise.operators import aggregates as A
from framewise.operators.columns import one_hot_sparse

DURATIONS = ["1 days", "1 day 06:05:01.00003", "15.5us", "3d4h", "-2 hours", "-1 days +06:00:00", "-1 days 06:00:00", "00:00:01", "30:00:01.5",
             "2 W", "1 day, 2 hours", "90 min", "90min 2s 3 ms", "  4 Hours ", "+1:30:00", "1.25 d"]


def test_durations_agree_with_pandas(spark):
    df = spark.createDataFrame([(t,) for t in DURATIONS], "t string")
    got = [r[0] for r in df.select(micros_of(to_timedelta("t"))).collect()]
    assert got == [round(pd.Timedelta(t).value / 1000) for t in DURATIONS]


def test_what_is_no_duration_is_null(spark):
    bad = ["", " ", "n/a", "1 fortnight", "5", "1:60:00", "1 day x", "days", "-", "1 h 2", "9" * 40 + " d", "9" * 13 + " s", None]
    df = spark.createDataFrame([(t,) for t in bad], "t string")
    assert [r[0] for r in df.select(to_timedelta("t")).collect()] == [None] * len(bad)
    one = spark.createDataFrame([("1:30",)], "t string").select(to_timedelta("t")).first()[0]
    assert one == dt.timedelta(hours=1, minutes=30)


def test_a_duration_is_taken_apart_once(spark):
    texts = ["3 weeks 250 ms", "-7h 1.5 s", "5 Days\t+1:00", "1s" * 20_000, "1:30\x01", "\x01" * 9, " " * 20_000 + "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(micros_of(to_timedelta("t")).alias("m"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_") <= 3 and plan.count("RLIKE") == 0
    assert [r["m"] for r in df.collect()] == [1_814_400_250_000, -25_201_500_000, 435_600_000_000, 20_000_000_000, None, None, None]


def test_sketches_merge_and_keep_ranks(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=60_000), np.full(20_000, 0.25)])   # a quarter of all rows tie
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(80_000) % 3, "day": np.arange(80_000) % 40, "v": values}))
    merged = A.merge_quantile_sketches(A.quantile_sketches(df, ["v"], ["g", "day"]), ["v"], ["g"])
    got = A.sketched_quantiles(merged, ["v"], [0.0, 0.1, 0.5, 0.99, 1.0], ["g"]).collect()
    for r in got:
        own = np.sort(values[np.arange(80_000) % 3 == r["g"]])
        assert r["v_n"] == len(own)
        assert r["v_p0"] == own[0] and r["v_p100"] == own[-1]
        for q, x in ((0.1, r["v_p10"]), (0.5, r["v_p50"]), (0.99, r["v_p99"])):
            lo, hi = np.searchsorted(own, x, "left") / len(own), np.searchsorted(own, x, "right") / len(own)
            assert lo - 0.02 <= q <= hi + 0.02


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (2, float("nan"))], "g int, v double")
    got = A.sketched_quantiles(A.quantile_sketches(df, ["v"], ["g"]), ["v"], [0.5], ["g"]).orderBy("g").collect()
    assert [tuple(r) for r in got] == [(1, None, 0), (2, 3.0, 1)]
    assert A.sketched_quantiles(A.quantile_sketches(df.limit(0), ["v"]), ["v"], [0.5]).collect()[0]["v_n"] == 0


def test_one_hot_of_many_categories(spark):
    df = spark.range(30_000).select((F.col("id") % 20_000).alias("n"), F.when(F.col("id") != 7, F.format_string("c%05d", F.col("id") % 20_000)).alias("c"))
    vectors, dictionary = one_hot_sparse(df, "c", "v")
    assert dictionary.count() == 20_000
    bad = vectors.where((F.col("v.size") != 20_000) | F.when(F.col("c").isNull(), F.size("v.indices") != 0).otherwise(
        (F.col("v.indices")[0] != F.col("n")) | (F.col("v.values")[0] != 1.0)))
    assert vectors.count() == 30_000 and bad.count() == 0
    empty, none = one_hot_sparse(df.limit(0), "c", "v")
    assert empty.count() == 0 and none.count() == 0
    nulls, none = one_hot_sparse(df.where("c is null"), "c", "v")
    assert [tuple(r["v"]) for r in nulls.collect()] == [(0, [], [])] and none.count() == 0
