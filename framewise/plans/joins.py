"""J-rows: joins and label alignment.

All-pairs products (cross_pairs, theta_pairs) are deliberately not built: they emit every
pair of rows and cannot survive a hot key or a growing table. See README.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.numeric import stable_round, stable_round_sql as R

from framewise.operators import joins as J
from framewise.plans.registry import register
from framewise.sources.tables import table


def _r(c, n=6):
    return stable_round(c, n)


@register("join_inner", sql="""
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, o.o_orderdate, l.l_extendedprice
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_join_inner(spark, d):
    li = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice"])
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).withColumnRenamed("o_orderkey", "l_orderkey")
    return J.join(li, o, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "o_custkey", "o_orderdate", "l_extendedprice")


@register("join_outer", sql="""
WITH o AS (SELECT o_custkey, count(*) AS n_orders, round((sum(o_totalprice)) + 5.123e-06, 2) AS total FROM orders
           WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT coalesce(c.c_custkey, o.o_custkey) AS custkey, c.c_name, o.n_orders, o.total
FROM customer c FULL JOIN o ON c.c_custkey = o.o_custkey""")
def q_join_outer(spark, d):
    c = table(spark, d, "customer", ["c_custkey", "c_name"]).withColumnRenamed("c_custkey", "custkey")
    o = (table(spark, d, "orders", ["o_custkey", "o_orderstatus", "o_totalprice"]).filter(F.col("o_orderstatus") == "P")
         .groupBy(F.col("o_custkey").alias("custkey"))
         .agg(F.count(F.lit(1)).alias("n_orders"), _r(F.sum("o_totalprice"), 2).alias("total")))
    return J.join(c, o, ["custkey"], "full")


@register("concat_columns_inner", sql="""
WITH c AS (SELECT c_nationkey AS nationkey, count(*) AS n_customers FROM customer GROUP BY 1),
     s AS (SELECT s_nationkey AS nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1)
SELECT c.nationkey, n_customers, n_suppliers FROM c JOIN s ON c.nationkey = s.nationkey""")
def q_concat_columns_inner(spark, d):
    c = table(spark, d, "customer", ["c_nationkey"]).groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    s = table(spark, d, "supplier", ["s_nationkey"]).groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_suppliers"))
    return J.join(c, s, ["nationkey"], "inner")


@register("join_broadcast_dim", sql="""
SELECT p.p_brand, round((sum(l.l_extendedprice)) + 5.123e-06, 2) AS revenue, count(*) AS n
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1""")
def q_join_broadcast_dim(spark, d):
    li = table(spark, d, "lineitem", ["l_partkey", "l_extendedprice"])
    part = table(spark, d, "part", ["p_partkey", "p_brand"])
    j = J.join_small(li, part, li["l_partkey"] == part["p_partkey"])
    return j.groupBy("p_brand").agg(_r(F.sum("l_extendedprice"), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@register("join_repartitioned", sql="""
SELECT c_mktsegment, count(*) AS n_orders, round((sum(o_totalprice)) + 5.123e-06, 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def q_join_repartitioned(spark, d):
    o = table(spark, d, "orders", ["o_custkey", "o_totalprice"]).withColumnRenamed("o_custkey", "custkey")
    c = table(spark, d, "customer", ["c_custkey", "c_mktsegment"]).withColumnRenamed("c_custkey", "custkey")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    j = J.join_repartitioned(o, c, ["custkey"], n)
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"), _r(F.sum("o_totalprice"), 2).alias("total"))


_DAILY_USER_SQL = """
WITH daily AS (SELECT date_trunc('day', ts) AS day, user_id, count(*) AS n_other, round((sum(value)) + 5.123e-10, 6) AS value_sum,
                      round((avg(value)) + 5.123e-10, 6) AS value_mean, max(value) AS value_max
               FROM events WHERE event_type <> 'purchase' GROUP BY 1, 2)
SELECT p.event_id, p.user_id, date_trunc('day', p.ts) AS day, p.value, d.n_other, d.value_sum, d.value_mean, d.value_max
FROM events p JOIN daily d ON date_trunc('day', p.ts) = d.day AND p.user_id = d.user_id
WHERE p.event_type = 'purchase'"""


def daily_user_join(spark, d):
    """Aggregate first (daily per user), then join the purchases to it on (day, user)."""
    ev = table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    daily = (ev.filter(F.col("event_type") != "purchase")
             .groupBy(F.date_trunc("day", "ts").alias("day"), "user_id")
             .agg(F.count(F.lit(1)).alias("n_other"), _r(F.sum("value")).alias("value_sum"),
                  _r(F.avg("value")).alias("value_mean"), F.max("value").alias("value_max")))
    buys = ev.filter(F.col("event_type") == "purchase").select(
        "event_id", "user_id", F.date_trunc("day", "ts").alias("day"), "value")
    return buys.join(daily, ["day", "user_id"], "inner")


register("join_one_to_many_resampled", sql=_DAILY_USER_SQL)(daily_user_join)


@register("lookup_map", sql="""
SELECT c_custkey, c_nationkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def q_lookup_map(spark, d):
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    n = table(spark, d, "nation", ["n_nationkey", "n_name"])
    return J.lookup_map(c, "c_nationkey", n, "n_nationkey", "n_name", "nation")


def _daily_series(spark, d):
    a = table(spark, d, "orders", ["o_orderdate"]).groupBy(F.col("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    b = table(spark, d, "lineitem", ["l_shipdate"]).groupBy(F.col("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_ship"))
    return a, b


_ALIGN_SQL = """
WITH a AS (SELECT o_orderdate AS day, count(*) AS n_orders FROM orders GROUP BY 1),
     b AS (SELECT l_shipdate AS day, count(*) AS n_ship FROM lineitem GROUP BY 1)
SELECT coalesce(a.day, b.day) AS day, {expr} FROM a FULL JOIN b ON a.day = b.day"""


@register("align_divide", sql=_ALIGN_SQL.format(expr="round((n_orders / n_ship) + 5.123e-13, 9) AS ratio"))
def q_align_divide(spark, d):
    a, b = _daily_series(spark, d)
    out = J.align_op(a, b, ["day"], "n_orders", "n_ship", "div", "ratio")
    return out.withColumn("ratio", _r(F.col("ratio"), 9))


@register("align_fill", sql=_ALIGN_SQL.format(expr="""
round((coalesce(n_orders, 1) / coalesce(n_ship, 1)) + 5.123e-13, 9) AS ratio_fill1,
coalesce(n_orders, 0) + coalesce(n_ship, 0) AS total_fill0"""))
def q_align_fill(spark, d):
    a, b = _daily_series(spark, d)
    r = J.align_op(a, b, ["day"], "n_orders", "n_ship", "div", "ratio_fill1", fill_value=1)
    t = J.align_op(a, b, ["day"], "n_orders", "n_ship", "add", "total_fill0", fill_value=0)
    return r.withColumn("ratio_fill1", _r(F.col("ratio_fill1"), 9)).join(t, "day")


@register("align_frame_by_series", sql="""
WITH a AS (SELECT o_orderdate AS day, count(*) AS n_orders, sum(o_totalprice) AS revenue FROM orders GROUP BY 1),
     b AS (SELECT l_shipdate AS day, count(*) AS n_ship FROM lineitem GROUP BY 1)
SELECT coalesce(a.day, b.day) AS day, round((n_orders / n_ship) + 5.123e-13, 9) AS n_orders, round((revenue / n_ship) + 5.123e-13, 9) AS revenue
FROM a FULL JOIN b ON a.day = b.day""")
def q_align_frame_by_series(spark, d):
    a = table(spark, d, "orders", ["o_orderdate", "o_totalprice"]).groupBy(F.col("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("revenue"))
    _, b = _daily_series(spark, d)
    out = J.align_frame_by_series(a, b, ["day"], "n_ship", "div")
    return out.select("day", _r(F.col("n_orders"), 9).alias("n_orders"), _r(F.col("revenue"), 9).alias("revenue"))


@register("align_common_keys", sql="""
WITH a AS (SELECT o_orderdate AS day, count(*) AS n_orders FROM orders GROUP BY 1),
     b AS (SELECT l_shipdate AS day, count(*) AS n_ship FROM lineitem GROUP BY 1)
SELECT a.day, round((n_orders / n_ship) + 5.123e-13, 9) AS ratio FROM a JOIN b ON a.day = b.day""")
def q_align_common_keys(spark, d):
    a, b = _daily_series(spark, d)
    out = J.align_op(a, b, ["day"], "n_orders", "n_ship", "div", "ratio", how="inner")
    return out.withColumn("ratio", _r(F.col("ratio"), 9))


@register("reindex_fill", sql="""
WITH per AS (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1),
     hist AS (SELECT k, count(*) AS n_customers FROM per GROUP BY 1),
     spine AS (SELECT unnest(generate_series(min(k), max(k))) AS k FROM hist)
SELECT spine.k, coalesce(n_customers, 0) AS n_customers FROM spine LEFT JOIN hist USING (k)""")
def q_reindex_fill(spark, d):
    per = table(spark, d, "orders", ["o_custkey"]).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"))
    hist = per.groupBy("k").agg(F.count(F.lit(1)).alias("n_customers"))
    return J.reindex_range(hist, "k", "n_customers", 0)


@register("join_then_group", sql="""
SELECT o_orderdate AS day, c_mktsegment, round((sum(o_totalprice)) + 5.123e-06, 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '2000-01-01'
GROUP BY 1, 2""")
def q_join_then_group(spark, d):
    o = table(spark, d, "orders", ["o_custkey", "o_orderdate", "o_totalprice"]).filter(
        F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    c = table(spark, d, "customer", ["c_custkey", "c_mktsegment"])
    j = J.join_small(o, c, o["o_custkey"] == c["c_custkey"])
    return j.groupBy(F.col("o_orderdate").alias("day"), "c_mktsegment").agg(_r(F.sum("o_totalprice"), 2).alias("total"))
