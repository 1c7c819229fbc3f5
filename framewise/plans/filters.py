"""F-rows: filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.operators import filters as Fl
from framewise.operators.aggregates import quantiles, row_all
from framewise.plans.registry import register
from framewise.sources.tables import table

_LI = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus"]


@register("filter_mask", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem
WHERE l_quantity > 30 AND l_discount < 0.05 AND l_returnflag <> 'N'""")
def q_filter_mask(spark, d):
    df = table(spark, d, "lineitem", _LI)
    df = Fl.filter_mask(df, (F.col("l_quantity") > 30) & (F.col("l_discount") < 0.05))
    return Fl.filter_mask(df, lambda x: x["l_returnflag"] != "N")


@register("filter_query", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem
WHERE 5 < l_quantity AND l_quantity < 20 AND 0.02 <= l_discount AND l_discount <= 0.06""")
def q_filter_query(spark, d):
    df = table(spark, d, "lineitem", _LI)
    return df.filter(Fl.between("l_quantity", 5, 20) & Fl.between("l_discount", 0.02, 0.06, "both"))


@register("filter_scalar_aggregate", sql="""
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < (SELECT quantile_cont(c_acctbal, 0.99) FROM customer)""")
def q_filter_scalar_aggregate(spark, d):
    df = table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    q99 = quantiles(df, ["c_acctbal"], [0.99], names={("c_acctbal", 0.99): "q"}).scalar()
    return Fl.filter_scalar_aggregate(df, "c_acctbal", "<", q99)


@register("filter_isin", sql="""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', 'NO-SUCH')""")
def q_filter_isin(spark, d):
    df = table(spark, d, "orders", ["o_orderkey", "o_orderpriority"])
    return Fl.filter_isin(df, "o_orderpriority", ["1-URGENT", "2-HIGH", "NO-SUCH"])


@register("filter_isin_topk", sql="""
SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_brand IN (
  SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 5)""")
def q_filter_isin_topk(spark, d):
    return Fl.filter_isin_topk(table(spark, d, "part", ["p_partkey", "p_brand", "p_retailprice"]), "p_brand", 5)


@register("slice_multilevel", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_linestatus IN ('F')""")
def q_slice_multilevel(spark, d):
    df = table(spark, d, "lineitem", _LI)
    return Fl.slice_keys(df, {"l_returnflag": ["A", "R"], "l_linestatus": "F"})


@register("slice_date_string", sql="""
SELECT o_orderkey, o_orderdate FROM orders
WHERE (o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01')
   OR (o_orderdate >= TIMESTAMP '1999-03-01' AND o_orderdate < TIMESTAMP '1999-04-01')""")
def q_slice_date_string(spark, d):
    df = table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    return Fl.slice_date_string(df, "o_orderdate", "1996", "1997").unionByName(
        Fl.slice_date_string(df, "o_orderdate", "1999-03"))


@register("drop_nulls", sql="""
WITH t AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS prio, nullif(o_orderstatus, 'P') AS status,
                  o_totalprice FROM orders)
SELECT 'any' AS how, * FROM t WHERE prio IS NOT NULL AND status IS NOT NULL
UNION ALL SELECT 'thresh3', * FROM t
WHERE (o_orderkey IS NOT NULL)::INT + (prio IS NOT NULL)::INT + (status IS NOT NULL)::INT + (o_totalprice IS NOT NULL)::INT >= 3""")
def q_drop_nulls(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice")
    a = Fl.drop_nulls(df, subset=["prio", "status"]).select(F.lit("any").alias("how"), "*")
    b = Fl.drop_nulls(df, thresh=3).select(F.lit("thresh3").alias("how"), "*")
    return a.unionByName(b)


@register("filter_quantile_band", sql="""
WITH q AS (SELECT quantile_cont(p_size, 0.05) AS s_lo, quantile_cont(p_size, 0.95) AS s_hi,
                  quantile_cont(p_retailprice, 0.05) AS p_lo, quantile_cont(p_retailprice, 0.95) AS p_hi FROM part)
SELECT p_partkey, p_size, p_retailprice FROM part, q
WHERE p_size > s_lo AND p_size < s_hi AND p_retailprice > p_lo AND p_retailprice < p_hi""")
def q_filter_quantile_band(spark, d):
    df = table(spark, d, "part", ["p_partkey", "p_size", "p_retailprice"])
    cols, a = ["p_size", "p_retailprice"], 0.05
    band = quantiles(df, cols, [a, 1 - a], names={(c, q): f"{c}_{i}" for c in cols for i, q in enumerate([a, 1 - a])})
    s = band.select(F.struct("*").alias("b")).scalar()  # one scalar subquery, referenced per column
    return df.filter(row_all([(F.col(c) > s[f"{c}_0"]) & (F.col(c) < s[f"{c}_1"]) for c in cols]))


@register("sample_rows", sql="""
SELECT c_custkey, c_name FROM customer ORDER BY md5(concat_ws('|', c_custkey::VARCHAR, '42')) LIMIT 100""")
def q_sample_rows(spark, d):
    return Fl.sample_rows(table(spark, d, "customer", ["c_custkey", "c_name"]), 100, ["c_custkey"], seed=42)
