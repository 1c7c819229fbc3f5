"""W-rows: same-shape window operators (skew-safe blocked windows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.numeric import stable_round, stable_round_sql as R

from framewise.operators import blocked as B
from framewise.operators import windows as W
from framewise.plans.registry import register
from framewise.sources.tables import table

EV = ["event_id", "ts", "user_id", "value"]


def _r(c, n=6):
    return stable_round(c, n)


@register("window_rank_average", sql="""
SELECT event_id, user_id, date_trunc('day', ts) AS day, value,
  floor(rank() OVER (PARTITION BY date_trunc('day', ts), user_id ORDER BY value)
        + (count(*) OVER (PARTITION BY date_trunc('day', ts), user_id, value) - 1) / 2.0)::BIGINT AS turn
FROM events""")
def q_window_rank_average(spark, d):
    ev = table(spark, d, "events", EV).withColumn("day", F.date_trunc("day", "ts")).drop("ts")
    r = B.rank_average(ev, ["day", "user_id"], "value", ["event_id"], name="turn")
    return r.withColumn("turn", F.col("turn").cast("bigint"))


@register("window_diff_days", sql="""
SELECT o_orderkey, o_custkey,
  date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) - 1 AS rest
FROM orders""")
def q_window_diff_days(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    x = B.lags(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", [1], fmt="prev")
    return x.select("o_orderkey", "o_custkey",
                    (F.datediff(F.col("o_orderdate").cast("date"), F.col("prev").cast("date")) - 1).cast("bigint").alias("rest"))


def _daily_by_priority(spark, d):
    o = table(spark, d, "orders", ["o_orderdate", "o_orderpriority", "o_totalprice"])
    return o.groupBy(F.col("o_orderdate").alias("day"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("y"), F.sum("o_totalprice").alias("revenue"))


@register("window_lag", sql="""
WITH s AS (SELECT o_orderdate AS day, o_orderpriority, count(*) AS y FROM orders GROUP BY 1, 2),
l AS (SELECT day, o_orderpriority, y AS y_L0, """ + ", ".join(
    f"lag(y, {k}) OVER (PARTITION BY o_orderpriority ORDER BY day) AS y_L{k}" for k in range(1, 6)) + """ FROM s)
SELECT * FROM l WHERE y_L1 IS NOT NULL AND y_L2 IS NOT NULL AND y_L3 IS NOT NULL AND y_L4 IS NOT NULL AND y_L5 IS NOT NULL""")
def q_window_lag(spark, d):
    s = _daily_by_priority(spark, d).drop("revenue")
    x = B.lags(s, ["o_orderpriority"], ["day"], "y", range(6))
    return x.drop("y").dropna()


@register("window_diff", sql="""
WITH s AS (SELECT date_trunc('month', o_orderdate) AS month, o_orderpriority, count(*) AS y FROM orders GROUP BY 1, 2)
SELECT month, o_orderpriority, y,
  y - lag(y, 1) OVER (PARTITION BY o_orderpriority ORDER BY month) AS y_diff1,
  y - lag(y, 12) OVER (PARTITION BY o_orderpriority ORDER BY month) AS y_diff12 FROM s""")
def q_window_diff(spark, d):
    o = table(spark, d, "orders", ["o_orderdate", "o_orderpriority"])
    s = o.groupBy(F.date_trunc("month", "o_orderdate").alias("month"), "o_orderpriority").agg(F.count(F.lit(1)).alias("y"))
    x = B.lags(s, ["o_orderpriority"], ["month"], "y", [1, 12], fmt="_l{k}")
    return x.select("month", "o_orderpriority", "y", (F.col("y") - F.col("_l1")).alias("y_diff1"),
                    (F.col("y") - F.col("_l12")).alias("y_diff12"))


@register("rolling_rows", sql="""
SELECT event_id, user_id, value,
  CASE WHEN count(value) OVER w >= 5 THEN round((sum(value) OVER w) + 5.123e-10, 6) END AS value_sum5,
  CASE WHEN count(value) OVER w >= 5 THEN round((avg(value) OVER w) + 5.123e-10, 6) END AS value_mean5
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def q_rolling_rows(spark, d):
    ev = table(spark, d, "events", EV)
    x = B.rolling(ev, ["user_id"], ["ts", "event_id"], "value", 5, ["sum", "mean"])
    return x.select("event_id", "user_id", "value", _r(F.col("value_sum5")).alias("value_sum5"),
                    _r(F.col("value_mean5")).alias("value_mean5"))


@register("rolling_centered", sql="""
WITH s AS (SELECT o_orderdate AS day, o_orderpriority, sum(o_totalprice) AS revenue FROM orders GROUP BY 1, 2)
SELECT day, o_orderpriority,
  CASE WHEN count(revenue) OVER w >= 30 THEN round((avg(revenue) OVER w) + 5.123e-08, 4) END AS revenue_mean30,
  CASE WHEN count(revenue) OVER w >= 30 THEN round((stddev_samp(revenue) OVER w) + 5.123e-08, 4) END AS revenue_std30
FROM s WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)""")
def q_rolling_centered(spark, d):
    s = _daily_by_priority(spark, d).drop("y")
    x = B.rolling(s, ["o_orderpriority"], ["day"], "revenue", 30, ["mean", "std"], center=True)
    return x.select("day", "o_orderpriority", _r(F.col("revenue_mean30"), 4).alias("revenue_mean30"),
                    _r(F.col("revenue_std30"), 4).alias("revenue_std30"))


@register("rolling_time", sql="""
SELECT event_id, user_id, round((avg(value) OVER (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN (INTERVAL 2 DAY - INTERVAL 1 MICROSECOND) PRECEDING AND CURRENT ROW)) + 5.123e-10, 6) AS value_mean_2d FROM events""")
def q_rolling_time(spark, d):
    ev = table(spark, d, "events", EV)
    x = B.rolling_time(ev, ["user_id"], "ts", "value", 2 * 86_400_000_000, ["mean"], fmt="value_mean_2d")
    return x.select("event_id", "user_id", _r(F.col("value_mean_2d")).alias("value_mean_2d"))


@register("expanding", sql="""
SELECT event_id, user_id, round((avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) + 5.123e-10, 6) AS value_expanding_mean FROM events""")
def q_expanding(spark, d):
    ev = table(spark, d, "events", EV)
    x = B.running(ev, ["user_id"], ["ts", "event_id"], "value", ["mean"])
    return x.select("event_id", "user_id", _r(F.col("value_expanding_mean")).alias("value_expanding_mean"))


@register("group_zscore", sql="""
SELECT event_id, user_id, round(((value - avg(value) OVER (PARTITION BY user_id))
  / stddev_samp(value) OVER (PARTITION BY user_id)) + 5.123e-10, 6) AS value_z FROM events""")
def q_group_zscore(spark, d):
    ev = table(spark, d, "events", EV)
    return W.group_zscore(ev, ["user_id"], "value").select("event_id", "user_id", _r(F.col("value_z")).alias("value_z"))


@register("row_trend", sql="""
SELECT o_orderdate AS day, count(*) AS y, (row_number() OVER (ORDER BY o_orderdate) - 1) AS trend
FROM orders GROUP BY 1""")
def q_row_trend(spark, d):
    s = table(spark, d, "orders", ["o_orderdate"]).groupBy(F.col("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("y"))
    return W.trend(s, ["day"])


@register("ewm_mean", sql="""
WITH s AS (SELECT o_orderdate AS day, sum(o_totalprice) / 1000 AS x FROM orders GROUP BY 1),
p AS (SELECT day, x, row_number() OVER (ORDER BY day) AS i FROM s)
SELECT a.day, round((sum(b.x * pow(0.97, a.i - b.i)) / sum(pow(0.97, a.i - b.i))) + 5.123e-10, 6) AS x_ewm
FROM p a JOIN p b ON b.i <= a.i GROUP BY a.day""")
def q_ewm_mean(spark, d):
    from framewise.operators.ewm import ewm_mean
    s = table(spark, d, "orders", ["o_orderdate", "o_totalprice"]).groupBy(F.col("o_orderdate").alias("day")).agg(
        (F.sum("o_totalprice") / 1000).alias("x"))
    return ewm_mean(s, "x", ["day"], alpha=0.03, name="x_ewm").select("day", _r(F.col("x_ewm")).alias("x_ewm"))
