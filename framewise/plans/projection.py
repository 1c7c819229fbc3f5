"""P-rows: projection and schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.operators import columns as C
from framewise.operators.ordering import positional_rows, row_number_global, columns_by_position
from framewise.plans.registry import register
from framewise.sources.tables import table


@register("select_columns", sql="SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def q_select_columns(spark, d):
    return C.select_columns(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@register("rename_columns", sql="""
SELECT c_custkey AS custkey, c_name AS name, c_nationkey, c_acctbal, c_mktsegment AS segment FROM customer""")
def q_rename_columns(spark, d):
    df = C.rename_columns(table(spark, d, "customer"), lambda c: c.strip().lower())
    return C.rename_columns(df, {"c_custkey": "custkey", "c_name": "name", "c_mktsegment": "segment"})


@register("assign_columns", sql="""
SELECT o_orderkey, year(o_orderdate)::BIGINT AS year, o_totalprice / 1000.0 AS price_k,
       floor(o_totalprice / 1000.0)::BIGINT AS price_band FROM orders""")
def q_assign_columns(spark, d):
    df = table(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    return C.assign(df,
                    year=lambda x: F.year("o_orderdate").cast("bigint"),
                    price_k=lambda x: F.col("o_totalprice") / 1000.0,
                    price_band=lambda x: F.floor(x["price_k"]).cast("bigint")).drop("o_orderdate", "o_totalprice")


@register("drop_columns", sql="SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def q_drop_columns(spark, d):
    return C.drop_columns(table(spark, d, "part"), ["p_name", "p_type"])


@register("add_suffix", sql="""
SELECT s_suppkey AS s_suppkey_1, s_name AS s_name_1, s_nationkey AS s_nationkey_1, s_acctbal AS s_acctbal_1 FROM supplier""")
def q_add_suffix(spark, d):
    return C.add_suffix(table(spark, d, "supplier"), "_1")


@register("select_numeric", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def q_select_numeric(spark, d):
    return C.select_numeric(table(spark, d, "lineitem"))


def _finished_only(df, status):
    return df.filter(F.col("o_orderstatus") == status)


def _with_tax(df, rate):
    return df.withColumn("gross", F.col("o_totalprice") * (1 + rate))


@register("pipe", sql="""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_totalprice * 1.5 AS gross FROM orders WHERE o_orderstatus = 'F'""")
def q_pipe(spark, d):
    df = table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    return df.transform(_finished_only, "F").transform(_with_tax, rate=0.5)


@register("key_columns", sql="""
SELECT o_custkey AS customer, o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS game_id, o_totalprice
FROM orders""")
def q_key_columns(spark, d):
    df = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    df = row_number_global(df, ["o_orderdate", "o_orderkey"], "game_id")
    return C.set_keys(df, ["o_custkey", "o_orderkey", "game_id"], {"o_custkey": "customer"}).drop("o_orderdate")


@register("positional_rows", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS p, count(*) OVER () AS n FROM orders)
WHERE p >= 1 AND p < n - 2""")
def q_positional_rows(spark, d):
    df = table(spark, d, "orders")
    return columns_by_position(positional_rows(df, ["o_orderdate", "o_orderkey"], 1, -2), 0, 3)


@register("conditional_update", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity > 45 THEN 0.0 ELSE l_discount END AS l_discount
FROM lineitem""")
def q_conditional_update(spark, d):
    df = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount"])
    return C.conditional_update(df, F.col("l_quantity") > 45, "l_discount", F.lit(0.0))


@register("where_mask", sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price_where,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS price_mask FROM orders""")
def q_where_mask(spark, d):
    df = table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    df = df.withColumns({"price_where": F.col("o_totalprice"), "price_mask": F.col("o_totalprice")})
    df = C.where_mask(df, F.col("o_orderstatus") == "F", ["price_where"])
    df = C.where_mask(df, F.col("o_orderstatus") == "F", ["price_mask"], inverse=True)
    return df.select("o_orderkey", "price_where", "price_mask")


@register("update_from", sql="""
WITH new AS (SELECT o_custkey, max(o_totalprice) AS c_acctbal FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey)
SELECT c.c_custkey, CASE WHEN n.o_custkey IS NOT NULL THEN n.c_acctbal ELSE c.c_acctbal END AS c_acctbal
FROM customer c LEFT JOIN new n ON c.c_custkey = n.o_custkey""")
def q_update_from(spark, d):
    cust = table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    new = (table(spark, d, "orders", ["o_custkey", "o_orderstatus", "o_totalprice"])
           .filter(F.col("o_orderstatus") == "P").groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg(F.max("o_totalprice").alias("c_acctbal")))
    return C.update_from(cust, new, ["c_custkey"], "c_acctbal")


@register("map_columns", sql="""
SELECT l_orderkey, l_linenumber, l_quantity * 2 + 1 AS l_quantity, l_extendedprice * 2 + 1 AS l_extendedprice FROM lineitem""")
def q_map_columns(spark, d):
    df = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])
    return C.map_columns(df, ["l_quantity", "l_extendedprice"], lambda c: c * 2 + 1)


@register("one_hot", sql="""
SELECT c_custkey, c_acctbal,
  (c_mktsegment = 'BUILDING')::INTEGER AS c_mktsegment_BUILDING,
  (c_mktsegment = 'FURNITURE')::INTEGER AS c_mktsegment_FURNITURE,
  (c_mktsegment = 'HOUSEHOLD')::INTEGER AS c_mktsegment_HOUSEHOLD,
  (c_mktsegment = 'MACHINERY')::INTEGER AS c_mktsegment_MACHINERY
FROM customer""")
def q_one_hot(spark, d):
    df = table(spark, d, "customer", ["c_custkey", "c_acctbal", "c_mktsegment"])
    return C.one_hot(df, ["c_mktsegment"], drop_first=True)


@register("one_hot_sparse", sql="""
WITH c AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL))
SELECT p_partkey, p_name, (SELECT count(*) FROM c) AS size, code AS place, CASE WHEN code IS NULL THEN 0 ELSE 1 END AS total
FROM part LEFT JOIN c USING (p_name)""")
def q_one_hot_sparse(spark, d):
    vectors, _ = C.one_hot_sparse(table(spark, d, "part", ["p_partkey", "p_name"]), "p_name", "v")
    return vectors.select("p_partkey", "p_name", F.col("v.size").cast("bigint").alias("size"), F.get("v.indices", F.lit(0)).cast("bigint").alias("place"),
                          F.size("v.values").alias("total"))


@register("drop_empty_columns", sql="""
SELECT date_trunc('hour', ts) AS hour,
  count(*) FILTER (WHERE event_type = 'click') AS click,
  count(*) FILTER (WHERE event_type = 'view') AS view
FROM events WHERE event_type IN ('click', 'view') GROUP BY 1""")
def q_drop_empty_columns(spark, d):
    ev = table(spark, d, "events", ["ts", "event_type"])
    cats = C.category_values(ev, "event_type")  # the full category list (a small dimension)
    kept = ev.filter(F.col("event_type").isin("click", "view"))
    wide = (kept.groupBy(F.date_trunc("hour", "ts").alias("hour")).pivot("event_type", cats)
            .agg(F.count(F.lit(1))).fillna(0, subset=cats))
    return C.drop_empty_columns(wide, cats)


@register("replace_values", sql="""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus
FROM orders""")
def q_replace_values(spark, d):
    df = table(spark, d, "orders", ["o_orderkey", "o_orderstatus"])
    return C.replace_values(df, "o_orderstatus", {"F": "finished", "O": "open"})
