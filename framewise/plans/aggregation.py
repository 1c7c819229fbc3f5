"""A-rows: grouped and global aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.numeric import stable_round, stable_round_sql as R

from framewise.operators import aggregates as A
from framewise.operators.filters import top_values
from framewise.operators.ordering import top_k
from framewise.operators.resample import fill_buckets
from framewise.plans.registry import register
from framewise.session import cut_lineage
from framewise.sources.tables import table


def _r(c, n=6):
    return stable_round(c, n)


@register("group_multi_agg", sql="""
SELECT l_returnflag, count(l_quantity) AS l_quantity_count, round((avg(l_quantity)) + 5.123e-10, 6) AS l_quantity_mean,
       sum(l_quantity) AS l_quantity_sum, max(l_quantity) AS l_quantity_max FROM lineitem GROUP BY 1""")
def q_group_multi_agg(spark, d):
    df = table(spark, d, "lineitem", ["l_returnflag", "l_quantity"])
    out = A.group_agg(df, ["l_returnflag"], {"l_quantity": ["count", "mean", "sum", "max"]})
    return out.withColumn("l_quantity_mean", _r(F.col("l_quantity_mean")))


@register("group_dict_agg", sql="""
SELECT l_returnflag, l_linestatus, round((sum(l_extendedprice)) + 5.123e-06, 2) AS revenue, round((avg(l_discount)) + 5.123e-10, 6) AS avg_disc,
       max(l_quantity) AS max_qty FROM lineitem GROUP BY 1, 2""")
def q_group_dict_agg(spark, d):
    df = table(spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_extendedprice", "l_discount", "l_quantity"])
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        _r(F.sum("l_extendedprice"), 2).alias("revenue"), _r(F.avg("l_discount")).alias("avg_disc"),
        F.max("l_quantity").alias("max_qty"))


@register("group_mean_all", sql="""
SELECT p_brand, round((avg(p_size)) + 5.123e-10, 6) AS p_size, round((avg(p_retailprice)) + 5.123e-10, 6) AS p_retailprice FROM part GROUP BY 1""")
def q_group_mean_all(spark, d):
    out = A.group_mean_all(table(spark, d, "part", ["p_brand", "p_size", "p_retailprice"]), ["p_brand"])
    return out.select("p_brand", *[_r(F.col(c)).alias(c) for c in ("p_size", "p_retailprice")])


@register("group_mode", sql="""
SELECT o_custkey, o_orderpriority FROM (
  SELECT o_custkey, o_orderpriority,
         row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn
  FROM orders GROUP BY 1, 2) WHERE rn = 1""")
def q_group_mode(spark, d):
    return A.group_mode(table(spark, d, "orders", ["o_custkey", "o_orderpriority"]), ["o_custkey"], "o_orderpriority")


_FIRST_SQL = """
WITH t AS (SELECT o_custkey, o_orderkey, o_orderdate, nullif(o_orderpriority, '1-URGENT') AS prio, o_totalprice FROM orders)
SELECT o_custkey, {f}(prio ORDER BY o_orderdate, o_orderkey) FILTER (WHERE prio IS NOT NULL) AS prio,
       {f}(o_totalprice ORDER BY o_orderdate, o_orderkey) AS o_totalprice FROM t GROUP BY 1"""


def _first_last(spark, d, last):
    df = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate",
                                          F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("prio"), "o_totalprice")
    return A.group_first(df, ["o_custkey"], ["prio", "o_totalprice"], ["o_orderdate", "o_orderkey"], last=last)


register("group_first", sql=_FIRST_SQL.format(f="first"))(lambda spark, d: _first_last(spark, d, False))
register("group_last", sql=_FIRST_SQL.format(f="last"))(lambda spark, d: _first_last(spark, d, True))


@register("value_counts", sql="SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY 1")
def q_value_counts(spark, d):
    return A.value_counts(table(spark, d, "lineitem", ["l_partkey"]), "l_partkey")


@register("group_count_nonnull", sql="""
SELECT o_orderstatus, count(nullif(o_orderpriority, '5-LOW')) AS n_prio FROM orders GROUP BY 1""")
def q_group_count_nonnull(spark, d):
    df = table(spark, d, "orders", ["o_orderstatus", "o_orderpriority"])
    return df.groupBy("o_orderstatus").agg(F.count(F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("n_prio"))


@register("group_ratio_of_sums", sql="""
SELECT l_returnflag, round((sum(l_extendedprice * l_discount) / sum(l_extendedprice)) + 5.123e-13, 9) AS disc_share FROM lineitem GROUP BY 1""")
def q_group_ratio_of_sums(spark, d):
    df = table(spark, d, "lineitem", ["l_returnflag", "l_extendedprice", "l_discount"]).withColumn(
        "disc", F.col("l_extendedprice") * F.col("l_discount"))
    return df.groupBy("l_returnflag").agg(_r(A.ratio_of_sums("disc", "l_extendedprice"), 9).alias("disc_share"))


@register("global_agg", sql="""
SELECT round((avg(l_extendedprice)) + 5.123e-10, 6) AS mean, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
       round((quantile_cont(l_extendedprice, 0.5)) + 5.123e-10, 6) AS median, count(*) AS len FROM lineitem""")
def q_global_agg(spark, d):
    df = table(spark, d, "lineitem", ["l_extendedprice"])
    med = A.median(df, "l_extendedprice", name="m").scalar()
    return df.agg(_r(F.avg("l_extendedprice")).alias("mean"), F.min("l_extendedprice").alias("min"),
                  F.max("l_extendedprice").alias("max"), _r(med).alias("median"), F.count(F.lit(1)).alias("len"))


_QS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@register("quantiles", sql="SELECT " + ", ".join(
    f"round((quantile_cont({c}, {q})) + 5.123e-10, 6) AS {A.qname(c, q)}" for c in ("l_quantity", "l_extendedprice") for q in _QS)
    + " FROM lineitem")
def q_quantiles(spark, d):
    cols = ["l_quantity", "l_extendedprice"]
    out = A.quantiles(table(spark, d, "lineitem", cols), cols, _QS)
    return out.select(*[_r(F.col(c)).alias(c) for c in out.columns])


_RANK_SLACK = 0.03


@register("quantiles_sketched", sql=f"""
SELECT l_linenumber, q::DOUBLE AS q, count(*) AS n, TRUE AS near FROM lineitem, (SELECT unnest({_QS}) AS q) GROUP BY 1, 2""")
def q_quantiles_sketched(spark, d):
    """Sketches by line number and month are stored, merged to line numbers and asked. Which value answers may differ from
    run to run, so the result says whether its true rank lies within ``_RANK_SLACK`` of the one asked for."""
    li = table(spark, d, "lineitem", ["l_linenumber", "l_shipdate", "l_extendedprice"])
    by_month = A.quantile_sketches(li.withColumn("month", F.trunc("l_shipdate", "month")), ["l_extendedprice"], ["l_linenumber", "month"])
    stored = cut_lineage(by_month, "sketches")
    asked = A.sketched_quantiles(A.merge_quantile_sketches(stored, ["l_extendedprice"], ["l_linenumber"]), ["l_extendedprice"],
                                 _QS, ["l_linenumber"])
    # one row a group, written so that the answers compared are those of one run
    answers = cut_lineage(asked, "answers")
    j = li.join(answers, "l_linenumber")
    x = F.col("l_extendedprice")
    ranks = [F.avg((op(x, F.col(A.qname("l_extendedprice", q)))).cast("double")).alias(f"{side}{i}")
             for i, q in enumerate(_QS) for side, op in (("lo", lambda a, b: a < b), ("hi", lambda a, b: a <= b))]
    got = j.groupBy("l_linenumber").agg(F.max("l_extendedprice_n").alias("n"), *ranks)
    near = [F.struct(F.lit(q).alias("q"), ((F.col(f"lo{i}") <= q + _RANK_SLACK) & (F.col(f"hi{i}") >= q - _RANK_SLACK)).alias("near"))
            for i, q in enumerate(_QS)]
    return got.select("l_linenumber", "n", F.explode(F.array(*near)).alias("s")).select("l_linenumber", "s.q", "n", "s.near")


@register("group_std", sql="""
SELECT l_linenumber, round((stddev_samp(l_extendedprice)) + 5.123e-10, 6) AS price_std FROM lineitem GROUP BY 1""")
def q_group_std(spark, d):
    df = table(spark, d, "lineitem", ["l_linenumber", "l_extendedprice"])
    return df.groupBy("l_linenumber").agg(_r(F.stddev_samp("l_extendedprice")).alias("price_std"))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("corr_matrix", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, 1.0::DOUBLE AS r" if a == b else
    f"SELECT '{a}' AS x, '{b}' AS y, round((corr({a}, {b})) + 5.123e-13, 9) AS r FROM lineitem"
    for a in _CORR for b in _CORR))
def q_corr_matrix(spark, d):
    out = A.corr_matrix(table(spark, d, "lineitem", _CORR), _CORR)
    return out.withColumn("r", _r(F.col("r"), 9))


@register("group_by_time", sql="""
SELECT event_type, date_trunc('day', ts) AS day, round((sum(value)) + 5.123e-10, 6) AS value_sum, count(*) AS n
FROM events GROUP BY 1, 2""")
def q_group_by_time(spark, d):
    df = table(spark, d, "events", ["event_type", "ts", "value"])
    return df.groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(
        _r(F.sum("value")).alias("value_sum"), F.count(F.lit(1)).alias("n"))


@register("group_level", sql="""
WITH t AS (SELECT l_returnflag, l_linestatus, l_linenumber, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2, 3)
SELECT l_linestatus, sum(qty) AS qty FROM t GROUP BY 1""")
def q_group_level(spark, d):
    df = table(spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"])
    t = df.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.sum("l_quantity").alias("qty"))
    return t.groupBy("l_linestatus").agg(F.sum("qty").alias("qty"))


@register("bool_mean", sql="""
SELECT o_orderpriority, round((avg((o_orderstatus = 'F')::INT)) + 5.123e-13, 9) AS share_f,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f FROM orders GROUP BY 1""")
def q_bool_mean(spark, d):
    df = table(spark, d, "orders", ["o_orderpriority", "o_orderstatus"])
    cond = F.col("o_orderstatus") == "F"
    return df.groupBy("o_orderpriority").agg(_r(A.bool_mean(cond), 9).alias("share_f"),
                                             F.count_if(cond).alias("n_f"))


@register("two_stage_agg", sql="""
WITH daily AS (SELECT date_trunc('day', o_orderdate) AS day, count(*) AS n FROM orders GROUP BY 1),
g AS (SELECT date_trunc('month', day) AS month, round((avg(n)) + 5.123e-10, 6) AS mean_daily FROM daily GROUP BY 1),
s AS (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM g)
SELECT s.month, mean_daily FROM s LEFT JOIN g ON s.month = g.month""")
def q_two_stage_agg(spark, d):
    df = table(spark, d, "orders", ["o_orderdate"])
    daily = df.groupBy(F.date_trunc("day", "o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    g = daily.groupBy(F.date_trunc("month", "day").alias("month")).agg(_r(F.avg("n")).alias("mean_daily"))
    return fill_buckets(g, "month", "INTERVAL 1 MONTH")


@register("partial_merge_counts", sql="""
SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, l_partkey LIMIT 100""")
def q_partial_merge_counts(spark, d):
    counts = A.value_counts(table(spark, d, "lineitem", ["l_partkey"]), "l_partkey")
    return top_k(counts, "count", 100, ["l_partkey"])


@register("multi_agg_shared", sql="""
SELECT 'mean_price' AS answer, NULL::BIGINT AS key, round((avg(l_extendedprice)) + 5.123e-10, 6) AS value FROM lineitem
UNION ALL SELECT 'top_supplier_revenue', key, value FROM (
  SELECT l_suppkey AS key, round((sum(l_extendedprice)) + 5.123e-06, 2) AS value FROM lineitem GROUP BY 1 ORDER BY value DESC, key LIMIT 10)
UNION ALL SELECT 'top_part_mean_qty', key, value FROM (
  SELECT l_partkey AS key, round((avg(l_quantity)) + 5.123e-10, 6) AS value FROM lineitem GROUP BY 1 ORDER BY value DESC, key LIMIT 10)""")
def q_multi_agg_shared(spark, d):
    shared = table(spark, d, "lineitem", ["l_suppkey", "l_partkey", "l_quantity", "l_extendedprice"])
    # One scan and one aggregation for the three answers; the aggregated rows are written once.
    groups = cut_lineage(shared.groupingSets([[], ["l_suppkey"], ["l_partkey"]], "l_suppkey", "l_partkey").agg(
        F.grouping_id().alias("level"), _r(F.avg("l_extendedprice")).alias("mean_price"),
        _r(F.sum("l_extendedprice"), 2).alias("revenue"), _r(F.avg("l_quantity")).alias("mean_qty")), "shared-aggregates")
    a = groups.where("level = 3").select(F.lit("mean_price").alias("answer"), F.lit(None).cast("bigint").alias("key"), F.col("mean_price").alias("value"))
    b = top_k(groups.where("level = 1").select(F.col("l_suppkey").alias("key"), F.col("revenue").alias("value")), "value", 10, ["key"])
    b = b.select(F.lit("top_supplier_revenue").alias("answer"), "key", "value")
    c = top_k(groups.where("level = 2").select(F.col("l_partkey").alias("key"), F.col("mean_qty").alias("value")), "value", 10, ["key"])
    c = c.select(F.lit("top_part_mean_qty").alias("answer"), "key", "value")
    return a.unionByName(b).unionByName(c)


@register("row_all", sql="""
SELECT l_orderkey, l_linenumber, coalesce(l_quantity > 10, false) AND coalesce(l_discount > 0.02, false)
       AND coalesce(l_tax > 0.02, false) AS all_ok FROM lineitem""")
def q_row_all(spark, d):
    df = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"])
    ok = A.row_all([F.col("l_quantity") > 10, F.col("l_discount") > 0.02, F.col("l_tax") > 0.02])
    return df.select("l_orderkey", "l_linenumber", ok.alias("all_ok"))


@register("group_top_sum", sql="""
SELECT l_suppkey, round((sum(l_extendedprice)) + 5.123e-06, 2) AS revenue FROM lineitem GROUP BY 1
ORDER BY revenue DESC, l_suppkey LIMIT 10""")
def q_group_top_sum(spark, d):
    df = table(spark, d, "lineitem", ["l_suppkey", "l_extendedprice"])
    g = df.groupBy("l_suppkey").agg(_r(F.sum("l_extendedprice"), 2).alias("revenue"))
    return top_k(g, "revenue", 10, ["l_suppkey"])
