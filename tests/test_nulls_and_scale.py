"""NULLs, gaps, offsets, ties and long frames: cases that the driver's tables do not hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.functions.dates import hhmm_to_timestamp
from framewise.functions.numeric import great_circle
from framewise.operators import aggregates as A
from framewise.operators import blocked as B
from framewise.operators import joins as J
from framewise.operators import ordering as O
from framewise.operators import reshape as R
from framewise.operators import resample as T
from framewise.operators import stats as M
from framewise.operators import udfs as G
from framewise.sources import files as S


def test_null_sorts_last(spark):
    df = spark.createDataFrame([(3.0,), (None,), (1.0,)], "x double")
    assert {r.x: r.position for r in O.sort_rows(df, ["x"]).collect()} == {1.0: 1, 3.0: 2, None: 3}


def test_positions_read_the_input_once(spark, tmp_path):
    spark.range(5000).selectExpr("id", "id % 3 as k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = O.with_positions(df, ["id"], ["k"], size_name="n")
    assert str(tmp_path) not in out._jdf.queryExecution().toString()  # what is left reads the written chunks
    assert out.where(F.col("pos") != F.floor(F.col("id") / 3)).count() == 0


def test_labels_must_match_bins():
    with pytest.raises(ValueError):
        R.bin_cut("x", [0, 1, 2, 3], ["a", "b"])


def test_pivot_refuses_unlisted_values(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", 3.0)], "k int, c string, v double")
    assert R.pivot(df, ["k"], "c", ["a", "b"], F.sum("v")).first().asDict() == {"k": 1, "a": 2.0, "b": 3.0}
    with pytest.raises(Exception, match="not listed: b"):
        R.pivot(df, ["k"], "c", ["a"], F.sum("v")).collect()


def test_resample_fills_each_keys_gaps(spark):
    rows = [("x", "2024-01-01 00:10:00", 1.0), ("x", "2024-01-01 05:20:00", 2.0), ("y", "2024-01-01 03:00:00", 4.0), (None, "2024-01-01 01:00:00", 1.0)]
    df = spark.createDataFrame(rows, "k string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp"))
    got = T.resample_agg(df, "ts", "hour", [F.sum("v").alias("s")], by=["k"]).collect()
    assert sorted((str(r.k), r.bucket.hour, r.s) for r in got) == sorted(
        [("x", h, {0: 1.0, 5: 2.0}.get(h)) for h in range(6)] + [("y", 3, 4.0), ("None", 1, 1.0)], key=lambda r: r[:2])


def test_months_and_weeks_without_rows(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0), ("2024-04-01", 2.0)], "d string, v double").select(F.col("d").cast("timestamp_ntz").alias("d"), "v")
    got = T.fill_buckets(df, "d", "INTERVAL 1 MONTH", fills={"v": 0.0}).collect()
    assert sorted((r.d.month, r.v) for r in got) == [(1, 1.0), (2, 0.0), (3, 0.0), (4, 2.0)]
    assert T.fill_buckets(df, "d", "INTERVAL 7 DAY").count() == 14
    assert T.fill_buckets(df.limit(0), "d", "INTERVAL 7 DAY").count() == 0


def test_groups_of_nulls_stay(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0), ("b", 2.0), ("b", None)], "k string, v double")
    assert {r.k: r.v for r in A.group_mode(df, ["k"], "v").collect()} == {"a": None, "b": 2.0}
    assert {r.k: r.v_p50 for r in A.quantiles(df, ["v"], [0.5], ["k"]).collect()} == {"a": None, "b": 2.0}


def test_quantiles_with_ties(spark):
    x = np.concatenate([np.zeros(3000), np.arange(50), np.full(700, 7.5)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(6)
    qs = [0.0, 0.1, 0.5, 0.801, 0.9, 0.95, 1.0]
    got = A.quantiles(df, ["v"], qs).first()
    assert [got[A.qname("v", q)] for q in qs] == pytest.approx(np.quantile(x, qs))


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e9])
def test_fit_far_from_zero(spark, offset):
    rng = np.random.default_rng(1)
    t = np.arange(1000.0)
    y = 2 * t + rng.standard_normal(1000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(t + offset, y, strict=True)], "t double, y double")
    fit = {r.term: r for r in M.ols(df, "y", ["t"]).collect()}
    slope = df.agg(F.regr_slope("y", "t")).first()[0]
    assert fit["t"].coef == pytest.approx(slope, rel=1e-6)
    x = np.column_stack([np.ones(1000), t])
    b = np.linalg.lstsq(x, y, rcond=None)[0]
    assert fit["t"].rss == pytest.approx(((y - x @ b) ** 2).sum(), rel=1e-6)


def test_zscore_far_from_zero(spark):
    df = spark.createDataFrame([("a", 1e9 + i) for i in (1, 2, 3)] + [("b", float(i)) for i in (1, 2, 3)], "k string, v double").repartition(4)
    got = sorted((r.k, r.v, r.z) for r in G.group_zscore_pandas(df, ["k"], "v", "z").collect())
    assert [z for _, _, z in got] == pytest.approx([-1, 0, 1, -1, 0, 1])


def test_long_frames(spark):
    df = spark.range(500).select(F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    got = B.lags(df, [], ["t"], "v", [0, 120], block_rows=50).collect()
    assert all(r["v_L120"] == (r.v - 120 if r.v >= 120 else None) for r in got)


def test_lookup_checks_its_keys_in_the_plan(spark):
    df, m = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="not unique: 1"):
        J.lookup_map(df, "k", m, "k", "v", "name").collect()


def test_failed_build_is_built_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    (tmp_path / "t").mkdir()
    assert S.materialize(spark, path, lambda: spark.range(3)).count() == 3
    assert S.materialize(spark, path, lambda: spark.range(9)).count() == 3


def test_times_need_no_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.createDataFrame([("2020-03-08", "230.0"), ("2020-03-08", "2400"), ("x", "5"), ("2020-03-08", "1a")], "d string, t string").select(
            hhmm_to_timestamp("d", "t").cast("string").alias("x")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.x for r in got] == ["2020-03-08 02:30:00", None, None, None]


def test_distance_of_near_and_opposite_points(spark):
    df = spark.createDataFrame([(10.0, 20.0, 10.0, 20.0 + 1e-7), (0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    near, far = (r.x for r in df.select(great_circle("a", "b", "c", "d").alias("x")).collect())
    assert near == pytest.approx(6373.0 * np.radians(1e-7) * np.cos(np.radians(10)), rel=1e-6)
    assert far == pytest.approx(6373.0 * np.pi)
