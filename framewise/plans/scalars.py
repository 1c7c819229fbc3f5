"""X-rows: scalar column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions import dates as D
from framewise.functions import numeric as N
from framewise.functions import text as Tx
from framewise.functions.numeric import stable_round
from framewise.operators.aggregates import median
from framewise.operators.ordering import with_positions
from framewise.plans.registry import register
from framewise.sources.tables import table


@register("str_extract", sql="""
SELECT p_partkey, p_name, CASE WHEN regexp_matches(p_name, '^([a-z]+) ring$')
  THEN regexp_extract(p_name, '^([a-z]+) ring$', 1) END AS ring_kind FROM part""")
def q_str_extract(spark, d):
    df = table(spark, d, "part", ["p_partkey", "p_name"])
    return df.withColumn("ring_kind", Tx.extract("p_name", r"^([a-z]+) ring$"))


@register("str_clean_pad_slice", sql="""
WITH t AS (SELECT l_orderkey, l_linenumber, regexp_replace(CAST(l_quantity AS VARCHAR), '\\.0$', '') AS q FROM lineitem),
p AS (SELECT *, CASE WHEN length(q) < 4 THEN lpad(q, 4, '0') ELSE q END AS padded FROM t)
SELECT l_orderkey, l_linenumber, padded, substr(padded, 1, 2) AS hh, substr(padded, 3, 2) AS mm FROM p""")
def q_str_clean_pad_slice(spark, d):
    df = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    padded = Tx.pad_left(Tx.strip_trailing_zero_decimal("l_quantity"), 4)
    return df.select("l_orderkey", "l_linenumber", padded.alias("padded"),
                     Tx.slice_text(padded, 0, 2).alias("hh"), Tx.slice_text(padded, 2, 4).alias("mm"))


@register("str_concat", sql="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' ' || nullif(o_orderstatus, 'P') || ':' || o_orderpriority AS label
FROM orders""")
def q_str_concat(spark, d):
    df = table(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    return df.select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "),
                                            F.nullif("o_orderstatus", F.lit("P")), F.lit(":"), "o_orderpriority").alias("label"))


@register("str_case_trim", sql="SELECT c_custkey, lower(trim(c_name)) AS name FROM customer")
def q_str_case_trim(spark, d):
    return table(spark, d, "customer", ["c_custkey", "c_name"]).select("c_custkey", Tx.clean_case("c_name").alias("name"))


@register("format_percent", sql="""
SELECT c_mktsegment, printf('%.2f%%', round((count(*) * 100.0 / (SELECT count(*) FROM customer)) + 5.123e-06, 2)) AS share,
       'Class ' || c_mktsegment AS label FROM customer GROUP BY 1""")
def q_format_percent(spark, d):
    c = table(spark, d, "customer", ["c_mktsegment"])
    total = c.select(F.count(F.lit(1))).scalar()
    g = c.groupBy("c_mktsegment").agg((F.count(F.lit(1)) / total).alias("share"))
    return g.select("c_mktsegment", F.format_string("%.2f%%", stable_round(F.col("share") * 100, 2)).alias("share"),
                    F.format_string("Class %s", F.col("c_mktsegment")).alias("label"))


def _dep_text():
    h, m = F.hour("ts"), F.minute("ts")
    return F.when(h == 0, 2400 + m).otherwise(h * 100 + m).cast("double").cast("string")


@register("parse_timestamp_coerce", sql="""
WITH t AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
  CAST(CAST(CASE WHEN hour(ts) = 0 THEN 2400 + minute(ts) ELSE hour(ts) * 100 + minute(ts) END AS DOUBLE) AS VARCHAR) AS raw FROM events),
c AS (SELECT *, regexp_replace(raw, '\\.0$', '') AS s FROM t),
p AS (SELECT *, CASE WHEN length(s) < 4 THEN lpad(s, 4, '0') ELSE s END AS hhmm FROM c)
SELECT event_id, raw, CASE WHEN length(hhmm) = 4 THEN
  try_strptime(day || ' ' || substr(hhmm, 1, 2) || ':' || substr(hhmm, 3, 2), '%Y-%m-%d %H:%M') END AS dep_time FROM p""")
def q_parse_timestamp_coerce(spark, d):
    ev = table(spark, d, "events", ["event_id", "ts"])
    raw = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), _dep_text().alias("raw"))
    return raw.select("event_id", "raw", D.hhmm_to_timestamp("day", "raw").alias("dep_time"))


@register("parse_date_format", sql="""
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%a, %b %-d, %Y') AS text FROM orders)
SELECT o_orderkey, text, strptime(regexp_replace(text, '^[A-Za-z]{3},\\s*', ''), '%b %d, %Y') AS parsed FROM t""")
def q_parse_date_format(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    t = o.select("o_orderkey", F.date_format("o_orderdate", "EEE, MMM d, yyyy").alias("text"))
    return t.withColumn("parsed", D.parse_date_weekday("text"))


@register("parse_number_coerce", sql="""
WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS text
           FROM lineitem)
SELECT l_orderkey, l_linenumber, text, TRY_CAST(text AS DOUBLE) AS qty,
       extract('day' FROM to_days(l_linenumber))::BIGINT AS lead_days FROM t""")
def q_parse_number_coerce(spark, d):
    li = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    t = li.withColumn("text", F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")))
    td = F.make_dt_interval(F.col("l_linenumber"))
    return t.select("l_orderkey", "l_linenumber", "text", D.to_number("text").alias("qty"),
                    F.extract(F.lit("DAY"), td).cast("bigint").alias("lead_days"))


@register("parse_interval", sql="""
SELECT l_orderkey, l_linenumber, CASE l_linenumber
    WHEN 1 THEN l_quantity::BIGINT * 86400000000 + 21600000000
    WHEN 2 THEN -(l_quantity::BIGINT * 3600000000 + 1500000)
    WHEN 3 THEN l_partkey * 60000000 + 7000000
    WHEN 4 THEN -l_quantity::BIGINT * 86400000000 + 3600000000
    WHEN 5 THEN l_quantity::BIGINT * 604800000000 + 250000 END AS micros FROM lineitem""")
def q_parse_interval(spark, d):
    """Durations written in five ways (and not at all) -> intervals, as microseconds."""
    li = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_partkey"])
    n, qty = F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
    text = (F.when(n == 1, F.concat(qty, F.lit(" days 06:00:00"))).when(n == 2, F.concat(F.lit("-"), qty, F.lit("h 1.5 s")))
            .when(n == 3, F.concat("l_partkey", F.lit(" min, 7 seconds"))).when(n == 4, F.concat(F.lit("-"), qty, F.lit(" Days +1:00")))
            .when(n == 5, F.concat(qty, F.lit("  weeks 250 ms"))).otherwise(F.lit("n/a")))
    return li.select("l_orderkey", "l_linenumber", D.micros_of(D.to_timedelta(text)).alias("micros"))


@register("date_parts", sql="""
SELECT event_id, hour(ts)::BIGINT AS hour, dayofweek(ts)::BIGINT AS dow,
       (date_diff('microsecond', (SELECT min(ts) FROM events), ts) // 86400000000)::BIGINT AS days FROM events""")
def q_date_parts(spark, d):
    ev = table(spark, d, "events", ["event_id", "ts"])
    first = ev.select(F.min("ts")).scalar()
    return ev.select("event_id", F.hour("ts").cast("bigint").alias("hour"),
                     (F.dayofweek("ts") - 1).cast("bigint").alias("dow"),
                     D.whole_days_between(first, F.col("ts")).alias("days"))


@register("date_offset", sql="""
SELECT o_orderkey, o_orderdate + INTERVAL 3 MONTH - INTERVAL 2 DAY AS shifted FROM orders""")
def q_date_offset(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    return o.select("o_orderkey", D.add_offset("o_orderdate", months=3, days=-2).alias("shifted"))


@register("timezone_convert", sql="""
WITH t AS (SELECT o_orderkey, o_orderdate + INTERVAL 90 MINUTE AS loc FROM orders),
c AS (SELECT o_orderkey, loc, timezone('America/New_York', loc) AS c1,
             timezone('America/New_York', loc - INTERVAL 1 HOUR) + INTERVAL 1 HOUR AS c2 FROM t)
-- an ambiguous wall-clock time (DST end) resolves to the earlier instant
SELECT o_orderkey, timezone('UTC', CASE WHEN timezone('America/New_York', c2) = loc THEN least(c1, c2) ELSE c1 END) AS utc_time
FROM c""")
def q_timezone_convert(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    local = F.col("o_orderdate") + F.expr("INTERVAL 90 MINUTES")
    return o.select("o_orderkey", D.localize_to_utc(local, "America/New_York").alias("utc_time"))


@register("holiday_dates", sql="""
WITH y AS (SELECT unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) AS year FROM orders),
f AS (SELECT year, make_date(year, 10, 1) AS first FROM y)
SELECT year::BIGINT AS year, CAST(first + to_days(((8 - isodow(first)) % 7)::INT + 7) AS TIMESTAMP) AS columbus_day FROM f""")
def q_holiday_dates(spark, d):
    ends = table(spark, d, "orders", ["o_orderdate"]).agg(F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi"))
    years = ends.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("year"))
    return years.select(F.col("year").cast("bigint").alias("year"),
                        D.nth_weekday_of_month(F.col("year"), 10, "MON", 2).cast("timestamp_ntz").alias("columbus_day"))


@register("date_spine_periods", sql="""
WITH b AS (SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem)
SELECT 'month' AS period, unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS start FROM b
UNION ALL
SELECT 'week', unnest(generate_series(date_trunc('week', lo), date_trunc('week', hi), INTERVAL 7 DAY)) FROM b""")
def q_date_spine_periods(spark, d):
    from framewise.operators.resample import bucket_spine
    li = table(spark, d, "lineitem", ["l_shipdate"])
    month, week = (bucket_spine(li, "l_shipdate", unit, "start").select(F.lit(unit).alias("period"), F.col("start").cast("timestamp_ntz").alias("start"))
                   for unit in ("month", "week"))
    return month.unionByName(week)


@register("date_spine", sql="""
SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS day FROM lineitem""")
def q_date_spine(spark, d):
    from framewise.operators.resample import bucket_spine
    li = table(spark, d, "lineitem", ["l_shipdate"])
    return bucket_spine(li, "l_shipdate", "day", "day").withColumn("day", F.col("day").cast("timestamp_ntz"))


def key_lat(k):
    return (F.pmod(k * 37, F.lit(180)) - 90).cast("double")


def key_lon(k):
    return (F.pmod(k * 91, F.lit(360)) - 180).cast("double")


def shipment_coordinates(spark, d):
    """Per lineitem: supplier and customer coordinates (made from their keys). Equi-joins
    only: lineitem -> orders on the order key, then the two dimensions."""
    li = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).drop("o_orderkey")
    return j.select("l_orderkey", "l_linenumber", key_lat(F.col("l_suppkey")).alias("lat_1"),
                    key_lon(F.col("l_suppkey")).alias("lon_1"), key_lat(F.col("o_custkey")).alias("lat_2"),
                    key_lon(F.col("o_custkey")).alias("lon_2"))


_GC_SQL = """
WITH c AS (SELECT l_orderkey, l_linenumber,
  (((l_suppkey * 37) % 180) - 90)::DOUBLE AS lat_1, (((l_suppkey * 91) % 360) - 180)::DOUBLE AS lon_1,
  (((o_custkey * 37) % 180) - 90)::DOUBLE AS lat_2, (((o_custkey * 91) % 360) - 180)::DOUBLE AS lon_2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
k AS (SELECT *, sin(radians(90 - lat_1)) * sin(radians(90 - lat_2)) * cos(radians(lon_1) - radians(lon_2))
              + cos(radians(90 - lat_1)) * cos(radians(90 - lat_2)) AS cosv FROM c)
SELECT l_orderkey, l_linenumber, round((acos(greatest(-1.0, least(1.0, cosv))) * 6373.0) + 5.123e-07, 3) AS distance_km FROM k"""


@register("great_circle", sql=_GC_SQL)
def q_great_circle(spark, d):
    c = shipment_coordinates(spark, d)
    return c.select("l_orderkey", "l_linenumber",
                    stable_round(N.great_circle("lat_1", "lon_1", "lat_2", "lon_2"), 3).alias("distance_km"))


@register("arith_cast_round", sql="""
SELECT p_partkey, round((((p_retailprice - 32) * 5 / 9)) + 5.123e-08, 4) AS celsius, p_retailprice / 1000 AS price_k,
       trunc(p_retailprice)::INTEGER AS price_int, round_even(p_size / 2.0, 0) AS half_size_even FROM part""")
def q_arith_cast_round(spark, d):
    p = table(spark, d, "part", ["p_partkey", "p_retailprice", "p_size"])
    return p.select("p_partkey", stable_round(N.fahrenheit_to_celsius("p_retailprice"), 4).alias("celsius"),
                    (F.col("p_retailprice") / 1000).alias("price_k"), F.col("p_retailprice").cast("int").alias("price_int"),
                    N.round_half_even(F.col("p_size") / 2.0, 0).alias("half_size_even"))


@register("fill_nulls", sql="""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price FROM orders)
SELECT o_orderkey, coalesce(price, 0) AS price_zero,
       coalesce(price, (SELECT quantile_cont(price, 0.5) FROM t)) AS price_median FROM t""")
def q_fill_nulls(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    t = o.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    med = median(t, "price", name="m").scalar()
    return t.select("o_orderkey", F.coalesce("price", F.lit(0.0)).alias("price_zero"),
                    F.coalesce("price", med).alias("price_median"))


def category_codes(df, column, name):
    """String -> dense integer code in sorted order; NULL -> -1. The distinct values are numbered
    in range chunks, however many there are, and joined back."""
    cats = df.select(column).where(F.col(column).isNotNull()).distinct()
    cats = with_positions(cats, [column], name=name).withColumn(name, F.col(name).cast("int"))
    out = df.join(cats, column, "left")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(-1)))


@register("category_codes", sql="""
WITH t AS (SELECT p_partkey, nullif(p_brand, 'Brand#1') AS brand FROM part),
c AS (SELECT brand, (dense_rank() OVER (ORDER BY brand) - 1)::INTEGER AS code FROM (SELECT DISTINCT brand FROM t WHERE brand IS NOT NULL))
SELECT p_partkey, t.brand, coalesce(code, -1) AS code FROM t LEFT JOIN c ON t.brand = c.brand""")
def q_category_codes(spark, d):
    p = table(spark, d, "part", ["p_partkey", "p_brand"]).select("p_partkey", F.nullif("p_brand", F.lit("Brand#1")).alias("brand"))
    return category_codes(p, "brand", "code").select("p_partkey", "brand", "code")


@register("category_restrict", sql="""
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderpriority END AS priority
FROM orders""")
def q_category_restrict(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_orderpriority"])
    cats = spark.createDataFrame([(c,) for c in ("1-URGENT", "2-HIGH", "3-MEDIUM")], "priority string")
    j = o.join(F.broadcast(cats), o["o_orderpriority"] == cats["priority"], "left")
    return j.select("o_orderkey", "priority")


@register("bool_columns", sql="""
SELECT o_orderkey, o_totalprice > 200000 AS is_big, o_orderpriority = '1-URGENT' AS is_urgent,
       o_totalprice - 100000 AS price_gap FROM orders""")
def q_bool_columns(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_totalprice", "o_orderpriority"])
    return o.select("o_orderkey", (F.col("o_totalprice") > 200000).alias("is_big"),
                    (F.col("o_orderpriority") == "1-URGENT").alias("is_urgent"),
                    (F.col("o_totalprice") - 100000).alias("price_gap"))
