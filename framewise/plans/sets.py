"""U-rows: set operations and concatenation."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.operators import sets as S
from framewise.plans.registry import register
from framewise.sources.tables import table


def _custs(spark, d, cond):
    return table(spark, d, "orders", ["o_custkey", "o_orderstatus", "o_orderdate"]).filter(cond).select(
        F.col("o_custkey").alias("custkey"))


def _in_year(year):
    """A range of dates, which is pushed to the scan (``year(date) = ...`` is not)."""
    return (F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))


@register("union_all", sql="""
SELECT o_orderkey, o_totalprice, NULL::TIMESTAMP AS o_orderdate FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, NULL, o_orderdate FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'P'""")
def q_union_all(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    a = o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    b = o.filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderdate")
    c = o.filter("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice", "o_orderdate")
    return S.union_all([a, b, c])


@register("set_intersect", sql="""
SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'
INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def q_set_intersect(spark, d):
    return S.intersect(*[_custs(spark, d, F.col("o_orderstatus") == s) for s in "FOP"])


@register("set_union", sql="""
SELECT o_custkey AS custkey FROM orders WHERE year(o_orderdate) = 1995
UNION SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2001""")
def q_set_union(spark, d):
    return S.union_distinct(_custs(spark, d, _in_year(1995)), _custs(spark, d, _in_year(2001)))


@register("set_difference", sql="""
(SELECT 'a_minus_b' AS direction, * FROM (SELECT o_custkey AS custkey FROM orders WHERE year(o_orderdate) = 1995
  EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2001))
UNION ALL
(SELECT 'b_minus_a', * FROM (SELECT o_custkey AS custkey FROM orders WHERE year(o_orderdate) = 2001
  EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1995))""")
def q_set_difference(spark, d):
    a = _custs(spark, d, _in_year(1995))
    b = _custs(spark, d, _in_year(2001))
    return (S.difference(a, b).select(F.lit("a_minus_b").alias("direction"), "custkey")
            .unionByName(S.difference(b, a).select(F.lit("b_minus_a").alias("direction"), "custkey")))


@register("set_symmetric_difference", sql="""
(SELECT custkey, 'left' AS side FROM (SELECT o_custkey AS custkey FROM orders WHERE year(o_orderdate) = 1995
  EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2001))
UNION ALL
(SELECT custkey, 'right' FROM (SELECT o_custkey AS custkey FROM orders WHERE year(o_orderdate) = 2001
  EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1995))""")
def q_set_symmetric_difference(spark, d):
    a = _custs(spark, d, _in_year(1995))
    b = _custs(spark, d, _in_year(2001))
    return S.symmetric_difference(a, b, "custkey")


@register("distinct_level", sql="SELECT DISTINCT l_returnflag FROM lineitem")
def q_distinct_level(spark, d):
    return S.distinct_values(table(spark, d, "lineitem", ["l_returnflag"]), "l_returnflag")
