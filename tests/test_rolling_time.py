"""Rolling time frames against pandas, spines under two time zones."""

import datetime as dt
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewise.operators import blocked as B
from framewise.operators import resample as T

HOUR = 3_600_000_000
AGGS = ["sum", "mean", "std", "min", "max", "count"]


def _events(seed, n=500):
    rng = np.random.default_rng(seed)
    ts = pd.Timestamp("1969-12-25") + pd.to_timedelta(rng.integers(0, 14 * 24 * 12, n) * 5, unit="min")  # ties, both sides of 1970
    v = 1e5 + rng.normal(size=n)
    v[rng.random(n) < 0.15] = np.nan
    return pd.DataFrame({"i": range(n), "k": np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b"], n)), "ts": ts, "v": v})


def _want(pdf, length):
    out = {}
    for _, g in pdf.groupby("k"):
        t, v = g.ts.values, g.v.values
        for i, now in zip(g.i, t, strict=True):
            x = v[(t > now - length) & (t <= now)]
            x = x[~np.isnan(x)]
            out[i] = [None] * 5 + [0] if not len(x) else [x.sum(), x.mean(), x.std(ddof=1) if len(x) > 1 else None, x.min(), x.max(), len(x)]
    return out


@pytest.mark.parametrize("length,slices", [(24 * HOUR, None), (24 * HOUR, 1), (6 * HOUR, 6), (7 * HOUR, 2)])
def test_frames_as_in_pandas(spark, length, slices):
    pdf = _events(length % 97)
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = B.rolling_time(df, ["k"], "ts", "v", length, AGGS, fmt="{agg}", slices=slices).collect()
    want = _want(pdf, np.timedelta64(length, "us"))
    assert len(got) == len(pdf)
    for r in got:
        for a, w in zip(AGGS, want[r["i"]], strict=True):
            assert (r[a] is None) == (w is None) and (w is None or r[a] == pytest.approx(w, rel=1e-9, abs=1e-9)), (r["i"], a, r[a], w)


def test_frames_without_keys_times_or_rows(spark):
    rows = [(None, 1.0, None), (dt.datetime(2020, 1, 1), 2.0, None), (dt.datetime(2020, 1, 1), 3.0, None), (dt.datetime(2020, 1, 2), 5.0, "x")]
    df = spark.createDataFrame(rows, "ts timestamp, v double, k string")
    got = sorted((r["v"], r["m"]) for r in B.rolling_time(df, [], "ts", "v", 24 * HOUR, ["mean"], fmt="m").collect())
    assert got == [(1.0, None), (2.0, 2.5), (3.0, 2.5), (5.0, 5.0)]
    got = sorted((r["v"], r["c"]) for r in B.rolling_time(df, ["k"], "ts", "v", 25 * HOUR, ["count"], fmt="c").collect())
    assert got == [(1.0, None), (2.0, 2), (3.0, 2), (5.0, 1)]
    assert B.rolling_time(df.limit(0), ["k"], "ts", "v", HOUR, AGGS).count() == 0
    with pytest.raises(ValueError):
        B.rolling_time(df, [], "ts", "v", 7, ["mean"], slices=2)


def test_a_hot_key_is_spread_and_no_row_copied(spark):
    df = spark.range(2000).select(F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * 60_000_000).alias("ts"), F.col("id").cast("double").alias("v"))
    out = B.rolling_time(df, ["k"], "ts", "v", 24 * HOUR, ["mean"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan and out.count() == 2000
    assert B._slices(24 * HOUR) == 256 and B._slices(30 * 24 * HOUR) >= 128


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(request, spark):
    """Driver and session in one zone."""
    old, old_tz = spark.conf.get("spark.sql.session.timeZone"), os.environ.get("TZ")
    os.environ["TZ"] = request.param
    time.tzset()
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)
    os.environ.pop("TZ") if old_tz is None else os.environ.update(TZ=old_tz)
    time.tzset()


def test_spines_lose_no_counts_in_any_zone(spark, zone):
    micros = [1_583_580_600_000_000, 1_583_580_700_000_000, 1_583_748_000_000_000]  # across New York's change of clocks in 2020
    df = spark.createDataFrame([(m, "a") for m in micros], "us long, k string").select(F.timestamp_micros("us").alias("ts"), "k")
    got = T.resample_by_keys(df, "ts", "hour", "k", ["a", "b"], F.count("*")).select(F.unix_micros("bucket").alias("us"), "k", "n").collect()
    assert sum(r["n"] for r in got) == 3
    hours = sorted({r["us"] for r in got})
    assert set(np.diff(hours)) == {HOUR} and len(got) == 2 * len(hours)
    days = [r[0] for r in T.bucket_spine(df, "ts", "day", "d").select(F.date_format("d", "yyyy-MM-dd HH:mm")).orderBy("d").collect()]
    assert days == ["2020-03-07 00:00", "2020-03-08 00:00", "2020-03-09 00:00"]


def test_spines_of_weeks_months_and_no_time_zone(spark, zone):
    df = spark.sql("SELECT timestamp_ntz'2020-02-10 05:00:00' AS t UNION ALL SELECT timestamp_ntz'2020-04-01 00:00:00'")
    text = lambda s: [r[0] for r in s.select(F.col("s").cast("string")).orderBy("s").collect()]
    assert text(T.bucket_spine(df, "t", "month", "s")) == ["2020-02-01 00:00:00", "2020-03-01 00:00:00", "2020-04-01 00:00:00"]
    weeks = text(T.bucket_spine(df, "t", "week", "s"))
    assert weeks[0] == "2020-02-10 00:00:00" and weeks[-1] == "2020-03-30 00:00:00" and len(weeks) == 8
    slots = text(T.bucket_spine(df, "t", "day", "s", step="hour", every=6))
    assert len(slots) == 51 * 4 + 1 and slots[1] == "2020-02-10 06:00:00" and slots[-1] == "2020-04-01 00:00:00"
    assert T.bucket_spine(df.limit(0), "t", "day", "s").count() == 0
