"""R-rows: wide/long reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.numeric import stable_round
from framewise.operators import reshape as Rs
from framewise.operators.aggregates import group_agg
from framewise.plans.registry import register
from framewise.sources.tables import table

_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _pname(v: str) -> str:
    return "p" + v.split("-")[0]


@register("melt", sql="""
SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
def q_melt(spark, d):
    df = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"])
    return Rs.melt(df, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@register("pivot_table", sql="""
SELECT l_returnflag,
  round((avg(l_extendedprice) FILTER (WHERE l_linestatus = 'F')) + 5.123e-10, 6) AS F,
  round((avg(l_extendedprice) FILTER (WHERE l_linestatus = 'O')) + 5.123e-10, 6) AS O
FROM lineitem GROUP BY 1""")
def q_pivot_table(spark, d):
    df = table(spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_extendedprice"])
    out = Rs.pivot(df, ["l_returnflag"], "l_linestatus", ["F", "O"], F.avg("l_extendedprice"))
    return out.select("l_returnflag", *[stable_round(F.col(c), 6).alias(c) for c in ("F", "O")])


def _year_prio_counts(spark, d):
    o = table(spark, d, "orders", ["o_orderdate", "o_orderpriority"])
    return o.groupBy(F.year("o_orderdate").cast("bigint").alias("year"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"))


@register("unstack", sql="""
SELECT year(o_orderdate)::BIGINT AS year, """ + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS {_pname(p)}" for p in _PRIOS) + """
FROM orders GROUP BY 1""")
def q_unstack(spark, d):
    out = Rs.unstack(_year_prio_counts(spark, d), ["year"], "o_orderpriority", "n", _PRIOS, fill=0)
    return out.toDF("year", *[_pname(p) for p in _PRIOS])


@register("stack", sql="""
SELECT l_returnflag, l_linestatus AS variable, count(*) AS value FROM lineitem GROUP BY 1, 2""")
def q_stack(spark, d):
    df = table(spark, d, "lineitem", ["l_returnflag", "l_linestatus"])
    wide = Rs.pivot(df, ["l_returnflag"], "l_linestatus", ["F", "O"], F.count(F.lit(1)))
    # count() of an absent pair is NULL after pivot: stack drops those cells
    wide = wide.select("l_returnflag", *[F.when(F.col(c) > 0, F.col(c)).alias(c) for c in ("F", "O")])
    return Rs.stack(wide, ["l_returnflag"], ["F", "O"])


@register("json_normalize", sql="""
SELECT event_id, event_type, json_extract(props, '$.k')::BIGINT AS k FROM events""")
def q_json_normalize(spark, d):
    ev = table(spark, d, "events", ["event_id", "event_type", "props"])
    return Rs.json_normalize(ev, "props", "k BIGINT", sep="_")


@register("json_normalize_variant", sql="""
SELECT event_id, CASE WHEN event_type = 'purchase' THEN value END AS amount,
       CASE WHEN event_type = 'click' THEN event_type WHEN event_type = 'purchase' THEN user_id::VARCHAR END AS note,
       json_extract(props, '$.k')::BIGINT AS props_k, CASE WHEN event_type <> 'view' THEN user_id END AS user_id FROM events""")
def q_json_normalize_variant(spark, d):
    """Records whose fields differ by the type of the event, and one of mixed types."""
    ev = table(spark, d, "events", ["event_id", "user_id", "event_type", "value", "props"])
    kind = F.col("event_type")
    record = F.concat(
        F.lit('{"props":'), F.coalesce("props", F.lit("null")),
        F.when(kind != "view", F.concat(F.lit(',"user":{"id":'), F.col("user_id"), F.lit("}"))).otherwise(""),
        F.when(kind == "purchase", F.concat(F.lit(',"amount":'), F.col("value"), F.lit(',"note":'), F.col("user_id")))
        .when(kind == "click", F.lit(',"note":"click"')).otherwise(""), F.lit("}"))
    out = Rs.json_normalize_variant(ev.select("event_id", record.alias("record")), "record", sep="_")
    return out.withColumn("note", F.regexp_replace("note", '^"|"$', ""))


_EDGES = [-1000.0, 0.0, 2500.0, 5000.0, 10000.0]
_LABELS = ["negative", "low", "mid", "high"]


@register("bin_cut", sql="""
SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 'negative'
  WHEN c_acctbal > 0 AND c_acctbal <= 2500 THEN 'low' WHEN c_acctbal > 2500 AND c_acctbal <= 5000 THEN 'mid'
  WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 'high' END AS band FROM customer""")
def q_bin_cut(spark, d):
    df = table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    return df.withColumn("band", Rs.bin_cut("c_acctbal", _EDGES, _LABELS))


@register("agg_flat_names", sql="""
SELECT p_brand, round((avg(p_retailprice)) + 5.123e-10, 6) AS p_retailprice_mean,
  round((sum(p_retailprice)) + 5.123e-06, 2) AS p_retailprice_sum, min(p_size) AS p_size_min, max(p_size) AS p_size_max
FROM part GROUP BY 1""")
def q_agg_flat_names(spark, d):
    df = table(spark, d, "part", ["p_brand", "p_retailprice", "p_size"])
    out = group_agg(df, ["p_brand"], {"p_retailprice": ["mean", "sum"], "p_size": ["min", "max"]})
    return out.withColumns({"p_retailprice_mean": stable_round("p_retailprice_mean", 6),
                            "p_retailprice_sum": stable_round("p_retailprice_sum", 2)})
