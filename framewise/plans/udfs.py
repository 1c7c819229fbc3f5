"""G-rows: the Python path and execution control."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.numeric import stable_round
from framewise.operators import udfs as G
from framewise.plans.registry import register
from framewise.plans.scalars import _GC_SQL, shipment_coordinates
from framewise.sources.tables import table


@register("udf_rowwise", sql=_GC_SQL)
def q_udf_rowwise(spark, d):
    c = shipment_coordinates(spark, d)
    far = G.apply_rows(c, G.great_circle_pandas, ["lat_1", "lon_1", "lat_2", "lon_2"], "km", "double")
    return far.select("l_orderkey", "l_linenumber", stable_round("km", 3).alias("distance_km"))


@register("udf_group_apply", sql="""
SELECT event_id, user_id, round(((value - avg(value) OVER (PARTITION BY user_id))
  / stddev_samp(value) OVER (PARTITION BY user_id)) + 5.123e-10, 6) AS value_z FROM events""")
def q_udf_group_apply(spark, d):
    ev = table(spark, d, "events", ["event_id", "user_id", "value"])
    z = G.group_zscore_pandas(ev, ["user_id"], "value", "value_z")
    return z.select("event_id", "user_id", stable_round(F.col("value_z"), 6).alias("value_z"))


@register("udaf_custom", sql="""
SELECT o_custkey, o_orderpriority FROM (
  SELECT o_custkey, o_orderpriority,
         row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn
  FROM orders GROUP BY 1, 2) WHERE rn = 1""")
def q_udaf_custom(spark, d):
    o = table(spark, d, "orders", ["o_custkey", "o_orderpriority"])
    return G.group_mode_pandas(o, ["o_custkey"], "o_orderpriority", "o_orderpriority")


def _keep_finished(df):
    return df.filter(F.col("o_orderstatus") == "F")


def _add_year(df):
    return df.withColumn("year", F.year("o_orderdate").cast("bigint"))


@register("log_shape", sql="""
SELECT o_orderkey, o_orderstatus, year(o_orderdate)::BIGINT AS year FROM orders WHERE o_orderstatus = 'F'""")
def q_log_shape(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    out = o.transform(G.logged("keep_finished", _keep_finished)).transform(G.logged("add_year", _add_year))
    return out.drop("o_orderdate")


@register("repartition", sql="SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def q_repartition(spark, d):
    li = table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    return li.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_partkey")
