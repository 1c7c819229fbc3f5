"""Joins partitioned by number: hot keys on one side, on both, NULL and unmatched, against a plain join."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewise.functions.numeric import random_normal, random_uniform
from framewise.operators import joins as J


def _sides(spark):
    # 1 is hot on the left, 2 on the right, 3 on both, 4 on the left alone, 5 on the right alone, NULL on both
    left = [(1, 0)] * 300 + [(3, i % 4) for i in range(60)] + [(4, 7)] * 200 + [(None, i) for i in range(150)] + [(k, k) for k in range(10, 60)] + [(2, 1)]
    right = [(2, i) for i in range(250)] + [(3, i) for i in range(70)] + [(5, 9)] * 200 + [(None, i) for i in range(120)] + [(k, -k) for k in range(30, 90)] + [(1, 5), (1, 6)]
    return (spark.createDataFrame(left, "k int, x int").repartition(5), spark.createDataFrame(right, "k int, y int").repartition(3))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_hot_keys_are_dealt_and_no_row_is_lost(spark, how):
    left, right = _sides(spark)
    got = J.join_repartitioned(left, right, ["k"], 16, how, least=20)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)


def test_hot_key_is_spread_over_tasks(spark):
    left = spark.range(40_000).select(F.lit(1).alias("k"), F.col("id").alias("x")).repartition(8)
    right = spark.createDataFrame([(1, 2), (3, 4)], "k int, y int")
    sizes = (J.join_repartitioned(left, right, ["k"], 16, least=1000).groupBy(F.spark_partition_id().alias("p")).count()
             .agg(F.sum("count").alias("all"), F.max("count").alias("most")).first())
    assert sizes["all"] == 40_000 and sizes["most"] < 16_000


def test_hot_table_is_small_and_cold_keys_stay_plain(spark):
    left, right = _sides(spark)
    hot = J.hot_keys(left, right, ["k"], 16, least=20)
    assert {r["k"]: r["_fw_met"] for r in hot.collect()} == {1: True, 2: True, 3: True, 4: False, 5: False, None: False}
    plain = J.join_repartitioned(left, right, ["k"], 8)
    assert "_fw_i" not in plain._jdf.queryExecution().toString()


def test_several_keys_of_unlike_types_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", i) for i in range(90)] + [(2, None, 0)] * 40, "k int, g string, x int")
    right = spark.createDataFrame([(1, "a", i) for i in range(50)] + [(2, None, 1)], "k bigint, g string, y int")
    for how in ("inner", "left", "right", "full"):
        got = J.join_repartitioned(left, right, ["k", "g"], 4, how, least=10)
        assert _rows(got) == _rows(left.join(right, ["k", "g"], how))
        none = J.join_repartitioned(left, right.limit(0), ["k", "g"], 4, how, least=10)
        assert _rows(none) == _rows(left.join(right.limit(0), ["k", "g"], how))
    with pytest.raises(ValueError):
        J.join_repartitioned(left, right, ["k"], 4, "left_semi")


def test_random_columns_do_not_hang_on_partitions(spark):
    df = spark.range(20_000)
    draw = lambda d: d.select("id", random_uniform("s", "id").alias("u"), random_normal("s", "id").alias("z"))
    a, b = draw(df.repartition(3)).toPandas().sort_values("id"), draw(df.repartition(7)).toPandas().sort_values("id")
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))
    assert 0 < a.u.min() and a.u.max() < 1 and abs(a.u.mean() - 0.5) < 0.01
    assert abs(a.z.mean()) < 0.03 and abs(a.z.std() - 1) < 0.03 and abs((a.z.abs() < 1.96).mean() - 0.95) < 0.01
