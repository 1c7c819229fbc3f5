"""T-rows: time-bucket resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.numeric import stable_round
from framewise.operators import resample as T
from framewise.plans.registry import register
from framewise.sources.tables import table


@register("resample_hour_mean", sql="""
WITH h AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS hour FROM events),
     m AS (SELECT date_trunc('hour', ts) AS hour, avg(value) AS v FROM events GROUP BY 1)
SELECT h.hour, round((m.v) + 5.123e-10, 6) AS value_mean FROM h LEFT JOIN m USING (hour)""")
def q_resample_hour_mean(spark, d):
    ev = table(spark, d, "events", ["ts", "value"])
    out = T.resample_agg(ev, "ts", "hour", [F.avg("value").alias("value_mean")], name="hour")
    return out.withColumn("value_mean", stable_round("value_mean", 6))


@register("resample_hour_by_key", sql="""
WITH f AS (SELECT * FROM events WHERE value > 300),
     h AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS hour FROM f),
     k AS (SELECT DISTINCT event_type FROM events),
     c AS (SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM f GROUP BY 1, 2)
SELECT h.hour, k.event_type, coalesce(c.n, 0) AS n FROM h CROSS JOIN k
LEFT JOIN c ON c.hour = h.hour AND c.event_type = k.event_type""")
def q_resample_hour_by_key(spark, d):
    ev = table(spark, d, "events", ["ts", "event_type", "value"])
    cats = ev.select("event_type").where("event_type is not null").distinct()  # every category, used or not
    return T.resample_by_keys(ev.filter(F.col("value") > 300), "ts", "hour", "event_type", cats,
                              F.count(F.lit(1)), name="hour", value_name="n")


@register("resample_day_sum", sql="""
WITH f AS (SELECT * FROM orders WHERE o_orderstatus = 'P'),
     s AS (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day FROM f),
     a AS (SELECT o_orderdate AS day, sum(o_totalprice) AS revenue FROM f GROUP BY 1)
SELECT s.day, round((coalesce(a.revenue, 0)) + 5.123e-06, 2) AS revenue FROM s LEFT JOIN a USING (day)""")
def q_resample_day_sum(spark, d):
    o = table(spark, d, "orders", ["o_orderdate", "o_orderstatus", "o_totalprice"]).filter(F.col("o_orderstatus") == "P")
    out = T.resample_agg(o, "o_orderdate", "day", [F.sum("o_totalprice").alias("revenue")], name="day")
    return out.withColumn("revenue", stable_round(F.coalesce(F.col("revenue"), F.lit(0.0)), 2))


@register("resample_5day_mean", sql="""
WITH f AS (SELECT min(o_orderdate) AS first FROM orders),
g AS (SELECT first + to_days((floor(date_diff('day', first, o_orderdate) / 5) * 5)::INT) AS bucket,
       round((avg(o_totalprice)) + 5.123e-08, 4) AS price_mean, count(*) AS n
FROM orders, f GROUP BY 1),
s AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 5 DAY)) AS bucket FROM g)
SELECT s.bucket, price_mean, coalesce(n, 0) AS n FROM s LEFT JOIN g ON s.bucket = g.bucket""")
def q_resample_5day_mean(spark, d):
    o = table(spark, d, "orders", ["o_orderdate", "o_totalprice"])
    first = o.select(F.min("o_orderdate")).scalar()
    b = T.resample_n_days("o_orderdate", 5, first).cast("timestamp_ntz")
    g = o.groupBy(b.alias("bucket")).agg(stable_round(F.avg("o_totalprice"), 4).alias("price_mean"),
                                         F.count(F.lit(1)).alias("n"))
    return T.fill_buckets(g, "bucket", "INTERVAL 5 DAY", fills={"n": 0})


@register("resample_week", sql="""
WITH g AS (SELECT date_trunc('week', o_orderdate) + INTERVAL 6 DAY AS week,
  round((avg(o_totalprice)) + 5.123e-08, 4) AS price_mean, round((sum(o_totalprice)) + 5.123e-06, 2) AS price_sum
FROM orders GROUP BY 1),
s AS (SELECT unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS week FROM g)
SELECT s.week, price_mean, coalesce(price_sum, 0) AS price_sum FROM s LEFT JOIN g ON s.week = g.week""")
def q_resample_week(spark, d):
    o = table(spark, d, "orders", ["o_orderdate", "o_totalprice"])
    g = o.groupBy(T.week_ending_sunday("o_orderdate").cast("timestamp_ntz").alias("week")).agg(
        stable_round(F.avg("o_totalprice"), 4).alias("price_mean"), stable_round(F.sum("o_totalprice"), 2).alias("price_sum"))
    return T.fill_buckets(g, "week", "INTERVAL 7 DAY", fills={"price_sum": 0.0})


@register("resample_up_6h", sql="""
WITH f AS (SELECT o_orderdate AS day, sum(o_totalprice) AS revenue FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
     s AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 6 HOUR)) AS slot FROM f)
SELECT s.slot, round((f.revenue) + 5.123e-06, 2) AS revenue FROM s LEFT JOIN f ON f.day = s.slot""")
def q_resample_up_6h(spark, d):
    o = table(spark, d, "orders", ["o_orderdate", "o_orderstatus", "o_totalprice"]).filter(F.col("o_orderstatus") == "P")
    daily = o.groupBy(F.col("o_orderdate").alias("slot")).agg(stable_round(F.sum("o_totalprice"), 2).alias("revenue"))
    spine = T.bucket_spine(daily, "slot", "day", "slot", step="hour", every=6).withColumn("slot", F.col("slot").cast("timestamp_ntz"))
    return spine.join(daily, "slot", "left")


@register("resample_month_start", sql="""
WITH g AS (SELECT date_trunc('month', o_orderdate) AS month, round((avg(o_totalprice)) + 5.123e-08, 4) AS price_mean
FROM orders GROUP BY 1),
s AS (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM g)
SELECT s.month, price_mean FROM s LEFT JOIN g ON s.month = g.month""")
def q_resample_month_start(spark, d):
    o = table(spark, d, "orders", ["o_orderdate", "o_totalprice"])
    g = o.groupBy(F.date_trunc("month", "o_orderdate").alias("month")).agg(
        stable_round(F.avg("o_totalprice"), 4).alias("price_mean"))
    return T.fill_buckets(g, "month", "INTERVAL 1 MONTH")
