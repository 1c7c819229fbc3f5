"""S-rows: sources and sinks. Each query writes its input files from a driver table
into a fresh folder under the shared checkpoint folder, then reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.numeric import random_bits, random_normal, stable_round
from framewise.operators import joins as J
from framewise.plans.registry import register
from framewise.session import scratch_path
from framewise.sources import files as S
from framewise.sources.tables import table

_CUST_SCHEMA = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@register("scan_csv", sql="SELECT c_custkey, c_name, c_acctbal FROM customer")
def q_scan_csv(spark, d):
    path = scratch_path(spark, "csv")
    c = table(spark, d, "customer")
    text = c.select(*[F.col(x).cast("string").alias(x) for x in c.columns])
    notes = c.limit(0).sparkSession.createDataFrame([("# exported customer table",) + (None,) * 4], text.schema)
    S.write_csv(notes.unionByName(text), path, encoding="ISO-8859-1", raw_comments=True)
    return S.read_csv(spark, path, _CUST_SCHEMA, header=True, comment="#", encoding="ISO-8859-1",
                      usecols=["c_custkey", "c_name", "c_acctbal"])


@register("scan_many_files", sql="""
SELECT event_type, count(*) AS n, round((sum(value)) + 5.123e-06, 2) AS value_sum FROM events GROUP BY 1""")
def q_scan_many_files(spark, d):
    path = scratch_path(spark, "many")
    ev = table(spark, d, "events", ["event_type", "value", "event_id"])
    ev.write.partitionBy("event_type").parquet(path)
    df = S.read_many(spark, f"{path}/event_type=*/*.parquet", provenance="source_file")
    df = df.withColumn("event_type", F.regexp_extract("source_file", "event_type=([^/]+)/", 1))
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), stable_round(F.sum("value"), 2).alias("value_sum"))


@register("scan_parquet_pruned", sql="SELECT l_orderkey, l_returnflag, l_quantity FROM lineitem WHERE l_quantity > 45")
def q_scan_parquet_pruned(spark, d):
    # ReadSchema holds the three columns; l_quantity > 45 is a PushedFilter on the scan.
    return table(spark, d, "lineitem", ["l_orderkey", "l_returnflag", "l_quantity"]).filter(F.col("l_quantity") > 45)


_FEATURES = ("type STRING, features ARRAY<STRUCT<id: BIGINT, type: STRING, "
             "properties: STRUCT<user_id: BIGINT, event_type: STRING, value: DOUBLE>, "
             "geometry: STRUCT<type: STRING, coordinates: ARRAY<DOUBLE>>>>")


@register("scan_json", sql="""
SELECT event_id AS id, user_id AS properties_user_id, event_type AS properties_event_type, value AS properties_value,
       'Point' AS geometry_type FROM events""")
def q_scan_json(spark, d):
    from framewise.operators.reshape import flatten_all
    path = scratch_path(spark, "json")
    ev = table(spark, d, "events", ["event_id", "user_id", "event_type", "value"])
    feat = F.struct(F.col("event_id").alias("id"), F.lit("Feature").alias("type"),
                    F.struct("user_id", "event_type", "value").alias("properties"),
                    F.struct(F.lit("Point").alias("type"),
                             F.array(F.col("value"), F.col("user_id").cast("double")).alias("coordinates")).alias("geometry"))
    # documents of at most 100 features each (a fixed-size bucket of ids, not a per-key group)
    docs = ev.groupBy(F.floor(F.col("event_id") / 100).alias("doc")).agg(F.collect_list(feat).alias("features"))
    docs.select(F.lit("FeatureCollection").alias("type"), "features").write.json(path)
    rec = S.read_json_records(spark, path, _FEATURES)
    flat = flatten_all(rec, "_")
    return flat.select("id", "properties_user_id", "properties_event_type", "properties_value", "geometry_type")


@register("scan_zip_csv", sql="SELECT n_nationkey, n_name, n_regionkey, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey")
def q_scan_zip_csv(spark, d):
    path = scratch_path(spark, "zip")
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    n = table(spark, d, "nation")
    src = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select("n_nationkey", "n_name", "n_regionkey", "c_custkey")
    S.write_zipped_csv(src, path, "nation_customers").collect()  # one row per archive
    out = S.read_zipped_csv(spark, f"{path}/*.csv.zip", "n_nationkey INT, n_name STRING, n_regionkey INT, c_custkey BIGINT")
    return out.drop("path")


@register("html_records", sql="""
WITH t AS (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS h,
                  regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS x FROM pages),
u AS (SELECT page_id, h, x, unnest(generate_series(1, len(h))) AS i FROM t)
SELECT page_id, (i - 1)::BIGINT AS pos,
  replace(replace(replace(replace(replace(replace(h[i], '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS href,
  replace(replace(replace(replace(replace(replace(x[i], '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS text
FROM u""")
def q_html_records(spark, d):
    return S.html_links(table(spark, d, "pages", ["page_id", "html"]), "html", ["page_id"])


@register("html_table_rows", sql="""
SELECT c_custkey // 50 AS page, c_custkey, c_name, c_mktsegment, n_name, n_name || ' ' || n_regionkey AS place
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_html_table_rows(spark, d):
    """Pages with a table of customers are made, at most 50 rows each, with a table in a cell, a wide heading and cells
    without ends, and read back."""
    c = table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    rows = J.join_small(c, n, c["c_nationkey"] == n["n_nationkey"]).select(
        "c_custkey", F.concat(F.lit("<tr><td>"), "c_custkey", F.lit("</td><td>"), "c_name", F.lit("<td>"), "c_mktsegment",
                              F.lit("<td><table><tr><td>"), "n_name", F.lit("<td>&#32;"), "n_regionkey", F.lit("</table>")).alias("tr"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "tr"))), lambda r: r["tr"]), "")
    pages = rows.groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(F.concat(
        F.lit("<html><script>'<table><tr><td>no'</script><table><thead><tr><th>key<th colspan=2>customer<th>place</thead>"),
        body, F.lit("</table></html>")).alias("html"))
    got = S.html_table_rows(pages, "html", ["page"])
    # the page's own table is the first; the tables in its cells follow, one for each of its rows after the heading
    own = got.where((F.col("table") == 0) & (F.col("row") > 0))
    inner = got.where(F.col("table") > 0).select("page", F.col("table").alias("row"), F.col("cells")[0].alias("n_name"))
    return own.join(inner, ["page", "row"]).select(
        "page", F.col("cells")[0].cast("bigint").alias("c_custkey"), F.col("cells")[1].alias("c_name"),
        F.col("cells")[2].alias("c_mktsegment"), "n_name", F.col("cells")[3].alias("place"))


@register("sink_csv_partitioned", sql="""
SELECT c_mktsegment, count(*) AS n, round((sum(c_acctbal)) + 5.123e-06, 2) AS acctbal FROM customer GROUP BY 1""")
def q_sink_csv_partitioned(spark, d):
    path = scratch_path(spark, "bysegment")
    S.write_csv(table(spark, d, "customer"), path, partition_by=["c_mktsegment"])
    back = spark.read.schema("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING") \
        .option("header", True).option("basePath", path).csv(f"{path}/c_mktsegment=*")
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), stable_round(F.sum("c_acctbal"), 2).alias("acctbal"))


@register("materialize_table", sql="""
SELECT o_orderdate AS day, count(*) AS n FROM orders GROUP BY 1""")
def q_materialize_table(spark, d):
    path = scratch_path(spark, "store") + "/daily_orders"

    def build():
        return table(spark, d, "orders", ["o_orderdate"]).groupBy(F.col("o_orderdate").alias("day")).agg(
            F.count(F.lit(1)).alias("n"))
    S.materialize(spark, path, build)          # builds and saves
    return S.materialize(spark, path, build)   # second call reads the stored table


@register("literal_table", sql="""
WITH s(o_orderstatus, status_name) AS (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial'))
SELECT s.o_orderstatus, status_name, count(*) AS n FROM orders JOIN s USING (o_orderstatus) GROUP BY 1, 2""")
def q_literal_table(spark, d):
    names = spark.createDataFrame([("F", "finished"), ("O", "open"), ("P", "partial")], "o_orderstatus string, status_name string")
    o = table(spark, d, "orders", ["o_orderstatus"])
    return o.join(F.broadcast(names), "o_orderstatus").groupBy("o_orderstatus", "status_name").agg(F.count(F.lit(1)).alias("n"))


def _bits_sql(seed: str) -> str:
    return f"('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|{seed}'), 1, 8))::BIGINT"


@register("synthetic_table", sql=f"""
SELECT {_bits_sql('42-name')} % 1000 AS name,
  TIMESTAMP '2001-01-01' + to_milliseconds({_bits_sql('42-stamp')} % 86400000) AS stamp,
  {_bits_sql('42-value')} % 1000000 AS value,
  round(sqrt(-2 * ln(({_bits_sql('42-value2-radius')} + 0.5::DOUBLE) / 4294967296)) *
    cos(2 * pi() * ({_bits_sql('42-value2-angle')} + 0.5::DOUBLE) / 4294967296) + 5.123e-10, 6) AS value2
FROM lineitem""")
def q_synthetic_table(spark, d, groups: int = 1000, seed: int = 42):
    """Random frame, one row per lineitem: group id, millisecond timestamps, integer and normal values, all drawn by
    the digest of the row's key, so that reruns and other partitionings give the same table."""
    li = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber"])
    bits = lambda column: random_bits(f"{seed}-{column}", "l_orderkey", "l_linenumber")
    day = F.lit("2001-01-01").cast("timestamp_ntz")
    second = (bits("stamp") % 86_400_000 / 1000).cast("decimal(18,6)")
    return li.select((bits("name") % groups).alias("name"),
                     (day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), second)).alias("stamp"),
                     (bits("value") % 1_000_000).alias("value"),
                     stable_round(random_normal(f"{seed}-value2", "l_orderkey", "l_linenumber")).alias("value2"))


@register("table_profile", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null FROM lineitem" for c, t in [
        ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
        ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
        ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]))
def q_table_profile(spark, d):
    return S.table_profile(table(spark, d, "lineitem"))
