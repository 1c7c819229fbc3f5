"""O-rows: sorts, limits, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.operators import ordering as O
from framewise.plans.registry import register
from framewise.sources.tables import table

_LI = ["l_orderkey", "l_linenumber", "l_extendedprice"]


@register("sort_rows", sql="""
SELECT c_custkey, c_nationkey, c_acctbal,
       row_number() OVER (ORDER BY c_nationkey, -c_acctbal, c_custkey) AS position FROM customer""")
def q_sort_rows(spark, d):
    df = table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    return O.sort_rows(df, ["c_nationkey", -F.col("c_acctbal"), "c_custkey"])


@register("top_k", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 5""")
def q_top_k(spark, d):
    return O.top_k(table(spark, d, "lineitem", _LI), "l_extendedprice", 5, ["l_orderkey", "l_linenumber"])


@register("bottom_k", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice, l_orderkey, l_linenumber LIMIT 5""")
def q_bottom_k(spark, d):
    return O.top_k(table(spark, d, "lineitem", _LI), "l_extendedprice", 5, ["l_orderkey", "l_linenumber"], largest=False)


@register("sort_tail", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC NULLS FIRST, l_orderkey DESC, l_linenumber DESC LIMIT 5""")
def q_sort_tail(spark, d):
    return O.sort_tail(table(spark, d, "lineitem", _LI), "l_extendedprice", 5, ["l_orderkey", "l_linenumber"])


@register("head", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def q_head(spark, d):
    return O.head(table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice"]), 10, ["o_orderkey"])
