"""End-to-end recipes (E-rows): compositions of the operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewise.operators import filters, resample, windows
from framewise.plans.registry import register
from framewise.session import cut_lineage
from framewise.sources.tables import table


def daily_traffic(spark: SparkSession, sf_dir: str, k: int = 3, window_rows: int = 24) -> DataFrame:
    """Top-k event types -> hourly counts over every hour x type -> 24-hour rolling sum.

    Long output (hour, event_type, n_events, events_24h): the wide, one-column-per-type
    chart table is ``reshape.unstack`` of it. Plan: pruned scan, one count aggregation for
    the top-k (its k values are pushed to the scan as a filter), one for hourly counts, whose
    small table also bounds the distributed hour spine, and a window partitioned by type over hour buckets (bounded by the calendar).
    """
    ev = table(spark, sf_dir, "events", ["ts", "event_type", "event_id"])
    ev = filters.drop_nulls(ev, subset=["ts", "event_type"])
    keys = [r[0] for r in filters.top_values(ev, "event_type", k).collect()]  # k values: bounded by construction
    kept = ev.where(F.col("event_type").isin(keys))
    hourly = resample.resample_by_keys(kept, "ts", "hour", "event_type", keys,
                                       F.count("event_id"), name="hour", value_name="n_events")
    return windows.rolling(hourly, "n_events", window_rows, ["hour"], ["event_type"], "sum", name="events_24h")


register("flow_daily_traffic", sql="""
WITH ev AS (SELECT ts, event_type, event_id FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL),
top AS (SELECT event_type FROM ev GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 3),
f AS (SELECT * FROM ev WHERE event_type IN (SELECT event_type FROM top)),
hours AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS hour FROM f),
cnt AS (SELECT date_trunc('hour', ts) AS hour, event_type, count(event_id) AS n FROM f GROUP BY ALL),
grid AS (SELECT h.hour, t.event_type, coalesce(c.n, 0) AS n_events
         FROM hours h CROSS JOIN top t LEFT JOIN cnt c ON c.hour = h.hour AND c.event_type = t.event_type)
SELECT hour, event_type, n_events,
       CASE WHEN count(n_events) OVER w >= 24 THEN sum(n_events) OVER w END::BIGINT AS events_24h
FROM grid WINDOW w AS (PARTITION BY event_type ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
""")(daily_traffic)


# ---------------------------------------------------------------- shared pieces

from framewise.functions import dates as D  # noqa: E402
from framewise.functions import text as Tx  # noqa: E402
from framewise.functions.numeric import great_circle, stable_round  # noqa: E402
from framewise.operators import blocked as B  # noqa: E402
from framewise.operators import columns as C  # noqa: E402
from framewise.operators import joins as J  # noqa: E402
from framewise.operators import reshape as Rs  # noqa: E402
from framewise.operators.aggregates import group_first, group_mode, quantiles, ratio_of_sums  # noqa: E402
from framewise.operators.ordering import positional_rows  # noqa: E402
from framewise.operators.plotdata import box_stats  # noqa: E402

_BOX = ["q1", "median", "q3"]


def _box_out(df):
    return df.withColumns({c: stable_round(c, 6) for c in _BOX})


_BOX_SQL = """
q AS (SELECT {k}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM t GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT t.{k}, round((q1) + 5.123e-10, 6) AS q1, round((median) + 5.123e-10, 6) AS median, round((q3) + 5.123e-10, 6) AS q3,
  min(value) FILTER (WHERE value >= lo AND value <= hi) AS whisker_lo, max(value) FILTER (WHERE value >= lo AND value <= hi) AS whisker_hi,
  count(*) FILTER (WHERE value < lo OR value > hi) AS n_outliers, count(value) AS n
FROM t JOIN f USING ({k}) GROUP BY t.{k}, q1, median, q3"""


# ---------------------------------------------------------------- E2, E3

@register("flow_turn_delay", sql="""
WITH e AS (SELECT event_id, date_trunc('day', ts) AS day, user_id, ts, value FROM events WHERE value < 500),
t AS (SELECT floor(rank() OVER (PARTITION BY day, user_id ORDER BY ts)
             + (count(*) OVER (PARTITION BY day, user_id, ts) - 1) / 2.0)::BIGINT AS turn, value FROM e),""" + _BOX_SQL.format(k="turn"))
def flow_turn_delay(spark, d):
    """Order within (day, user), then the value distribution by turn number."""
    ev = table(spark, d, "events", ["event_id", "ts", "user_id", "value"]).dropna()
    ev = ev.filter(F.col("value") < 500).withColumn("day", F.date_trunc("day", "ts"))
    ranked = B.rank_average(ev, ["day", "user_id"], "ts", ["event_id"], name="turn")
    ranked = ranked.withColumn("turn", F.col("turn").cast("bigint"))
    return _box_out(box_stats(ranked, ["turn"], "value"))


@register("flow_hour_delay", sql="""
WITH t AS (SELECT hour(ts)::BIGINT AS hour, value FROM events WHERE 5 < value AND value < 600),""" + _BOX_SQL.format(k="hour"))
def flow_hour_delay(spark, d):
    ev = table(spark, d, "events", ["ts", "value"]).dropna()
    ev = ev.withColumn("hour", F.hour("ts").cast("bigint")).filter(filters.between("value", 5, 600))
    return _box_out(box_stats(ev, ["hour"], "value"))


# ---------------------------------------------------------------- E4

_SEX = {"AUTOMOBILE": 1, "BUILDING": 1, "FURNITURE": 0, "HOUSEHOLD": 0, "MACHINERY": 0}


@register("flow_survival_table", sql="""
WITH c AS (SELECT c_custkey, c_acctbal, c_mktsegment, n_regionkey AS pclass FROM customer JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT * FROM c WHERE c_acctbal < (SELECT quantile_cont(c_acctbal, 0.99) FROM c)),
b AS (SELECT *, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 1 ELSE 0 END AS sex,
             (SELECT min(c_acctbal) FROM f) AS lo, (SELECT max(c_acctbal) FROM f) AS hi FROM f),
g AS (SELECT CASE WHEN c_acctbal > lo AND c_acctbal <= 2000 THEN 'low' WHEN c_acctbal > 2000 AND c_acctbal <= 6000 THEN 'mid'
                  WHEN c_acctbal > 6000 AND c_acctbal <= hi THEN 'high' END AS band, pclass, sex FROM b)
SELECT band, """ + ", ".join(
    f"""printf('%.2f%%', round((avg(sex) FILTER (WHERE pclass = {k}) * 100) + 5.123e-06, 2)) AS "Class {k}\"""" for k in range(5)) + """
FROM g WHERE band IS NOT NULL GROUP BY band""")
def flow_survival_table(spark, d):
    """Filter below the 99th percentile -> 0/1 code -> fill + bin -> pivot mean by class ->
    "Class k" columns as percent text."""
    c = table(spark, d, "customer", ["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"])
    n = table(spark, d, "nation", ["n_nationkey", "n_regionkey"])
    c = J.join_small(c, n, c["c_nationkey"] == n["n_nationkey"]).withColumnRenamed("n_regionkey", "pclass")
    q99 = quantiles(c, ["c_acctbal"], [0.99], names={("c_acctbal", 0.99): "q"}).scalar()
    f = filters.filter_scalar_aggregate(c, "c_acctbal", "<", q99)
    f = C.replace_values(f.withColumn("sex", F.col("c_mktsegment")), "sex", {k: str(v) for k, v in _SEX.items()})
    f = f.withColumn("sex", F.col("sex").cast("int"))
    med = quantiles(f, ["c_acctbal"], [0.5], names={("c_acctbal", 0.5): "m"}).scalar()
    f = f.withColumn("age", F.coalesce("c_acctbal", med))
    r = f.select(F.struct(F.min("age").alias("lo"), F.max("age").alias("hi")).alias("r")).scalar()
    band = F.when((F.col("age") > r["lo"]) & (F.col("age") <= 2000), "low").when(
        (F.col("age") > 2000) & (F.col("age") <= 6000), "mid").when((F.col("age") > 6000) & (F.col("age") <= r["hi"]), "high")
    f = f.withColumn("band", band).filter(F.col("band").isNotNull())
    wide = Rs.pivot(f, ["band"], "pclass", list(range(5)), F.avg("sex"), fmt="Class {v}")
    return wide.select("band", *[Tx.percent(stable_round(F.col(f"`Class {k}`") * 100, 2) / 100).alias(f"Class {k}")
                                 for k in range(5)])


# ---------------------------------------------------------------- E5

@register("flow_weather_join", sql="""
WITH o AS (SELECT date_trunc('day', ts) AS day, user_id, event_type, value FROM events WHERE event_type <> 'purchase'),
m AS (SELECT day, user_id, event_type AS top_type FROM (
        SELECT day, user_id, event_type, row_number() OVER (PARTITION BY day, user_id ORDER BY count(*) DESC, event_type) AS rn
        FROM o GROUP BY 1, 2, 3) WHERE rn = 1),
a AS (SELECT day, user_id, round((avg(value)) + 5.123e-10, 6) AS value_mean, max(value) AS value_max, count(*) AS n_other FROM o GROUP BY 1, 2)
SELECT p.event_id, p.user_id, date_trunc('day', p.ts) AS day, p.value, a.value_mean, a.value_max, a.n_other, m.top_type
FROM events p JOIN a ON date_trunc('day', p.ts) = a.day AND p.user_id = a.user_id
JOIN m ON m.day = a.day AND m.user_id = a.user_id WHERE p.event_type = 'purchase'""")
def flow_weather_join(spark, d):
    """Daily per-user summary of the other events (mean, max, count, most frequent type)
    joined to each purchase on (day, user) -- aggregate first, then join."""
    ev = table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"]).withColumn(
        "day", F.date_trunc("day", "ts"))
    other = ev.filter(F.col("event_type") != "purchase")
    daily = other.groupBy("day", "user_id").agg(stable_round(F.avg("value"), 6).alias("value_mean"),
                                                F.max("value").alias("value_max"), F.count(F.lit(1)).alias("n_other"))
    top = group_mode(other, ["day", "user_id"], "event_type", "top_type")
    buys = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "day", "value")
    return buys.join(daily, ["day", "user_id"]).join(top, ["day", "user_id"])


# ---------------------------------------------------------------- E6, E7, E8 (games stand-in)

def games(spark, d):
    """One 'game' per lineitem: home = customer's nation, away = supplier's nation,
    date = ship date; points from quantity and tax. The game id is
    (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity): order and line number alone
    repeat, and without the quantity one pair still repeats at sf0.001."""
    li = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax",
                                      "l_shipdate"])
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    s = table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    g = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    g = J.join_small(g, c, g["o_custkey"] == c["c_custkey"])
    g = J.join_small(g, s, g["l_suppkey"] == s["s_suppkey"])
    return g.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("qty"),
                    F.col("l_shipdate").alias("date"),
                    F.col("s_nationkey").cast("bigint").alias("away_team"), F.col("c_nationkey").cast("bigint").alias("home_team"),
                    F.col("l_quantity").alias("home_points"), (F.col("l_tax") * 500).alias("away_points"))


_GAMES_SQL = """
g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS qty, l_shipdate AS date, s_nationkey::BIGINT AS away_team,
             c_nationkey::BIGINT AS home_team, l_quantity AS home_points, l_tax * 500 AS away_points
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
tidy AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qty, date, 'away_team' AS variable, away_team AS team FROM g
         UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qty, date, 'home_team', home_team FROM g),
r AS (SELECT *, date_diff('day', lag(date) OVER (PARTITION BY team
        ORDER BY date, l_orderkey, l_linenumber, l_partkey, l_suppkey, qty, variable), date) - 1 AS rest FROM tidy)"""


GAME_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "qty"]


def tidy_rest(spark, d):
    """melt the two roles into (game, date, variable, team), then days since the team's
    previous game minus one. The previous game's date comes from distinct (team, date)
    pairs (``previous_leading``): no sort of all rows, and a team with a third of all
    games is combined map-side."""
    tidy = Rs.melt(games(spark, d), [*GAME_KEY, "date"], ["away_team", "home_team"], "variable", "team")
    lagged = B.previous_leading(tidy, ["team"], "date", [*GAME_KEY, "variable"], name="_prev")
    return lagged.withColumn("rest", (F.datediff(F.col("date").cast("date"), F.col("_prev").cast("date")) - 1).cast("bigint")).drop("_prev")


@register("flow_rest_days", sql="WITH" + _GAMES_SQL + """
SELECT g.l_orderkey, g.l_linenumber, g.l_partkey, g.l_suppkey, g.qty, g.date, g.away_team, g.home_team,
  max(rest) FILTER (WHERE variable = 'away_team') AS away_rest, max(rest) FILTER (WHERE variable = 'home_team') AS home_rest,
  max(rest) FILTER (WHERE variable = 'home_team') - max(rest) FILTER (WHERE variable = 'away_team') AS rest_diff
FROM g JOIN r ON g.l_orderkey = r.l_orderkey AND g.l_linenumber = r.l_linenumber AND g.l_partkey = r.l_partkey
  AND g.l_suppkey = r.l_suppkey AND g.qty = r.qty GROUP BY ALL""")
def flow_rest_days(spark, d):
    """Rest days of both teams of every game. The games are put together and written once. Only the first game of a team's
    day looks back to the team's previous day, so one row per (team, day) is enough, and both teams of a game look it up."""
    g = cut_lineage(games(spark, d), "games")
    tidy = Rs.melt(g, [*GAME_KEY, "date"], ["away_team", "home_team"], "variable", "team")
    days = tidy.groupBy("team", "date").agg(F.min(F.struct(*GAME_KEY, "variable")).alias("_first"))
    previous = F.lag("date", 1).over(Window.partitionBy("team").orderBy("date"))   # at most the calendar's days a team
    rest = (F.datediff(F.col("date").cast("date"), previous.cast("date")) - 1).cast("bigint")
    days = cut_lineage(days.select("team", "date", "_first", rest.alias("_rest")), "team-days")
    out = g.select(*GAME_KEY, "date", "away_team", "home_team")
    for role in ("away", "home"):
        side = days.select(F.col("team").alias(f"{role}_team"), "date", F.col("_first").alias(f"_{role}_first"),
                           F.col("_rest").alias(f"_{role}"))
        own = F.struct(*GAME_KEY, F.lit(f"{role}_team").alias("variable"))
        out = out.join(side, [f"{role}_team", "date"], "left").withColumn(
            f"{role}_rest", F.when(own == F.col(f"_{role}_first"), F.col(f"_{role}")).when(F.col(f"{role}_team").isNotNull(), F.lit(-1).cast("bigint")))
    return out.select(*GAME_KEY, "date", "away_team", "home_team", "away_rest", "home_rest",
                      (F.col("home_rest") - F.col("away_rest")).alias("rest_diff"))


@register("flow_win_percent", sql="""
WITH g AS (SELECT l_orderkey, l_linenumber, s_nationkey::BIGINT AS away_team, c_nationkey::BIGINT AS home_team,
             l_quantity AS home_points, l_tax * 500 AS away_points
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
w AS (SELECT home_team AS team, 'home_team' AS is_home, (away_points < home_points)::INT AS win FROM g
      UNION ALL SELECT away_team, 'away_team', (NOT (away_points < home_points))::INT FROM g),
t AS (SELECT team, sum(win) / count(*) AS pct FROM (SELECT team, is_home, sum(win) AS win, count(*) AS n FROM w GROUP BY 1, 2) x,
      LATERAL (SELECT 1) GROUP BY team),
tp AS (SELECT team, sum(nw) / sum(ng) AS pct FROM (SELECT team, is_home, sum(win) AS nw, count(*) AS ng FROM w GROUP BY 1, 2) GROUP BY team)
SELECT l_orderkey, l_linenumber, round((a.pct) + 5.123e-13, 9) AS away_strength, round((h.pct) + 5.123e-13, 9) AS home_strength,
       home_points - away_points AS point_diff
FROM g LEFT JOIN tp a ON g.away_team = a.team LEFT JOIN tp h ON g.home_team = h.team""")
def flow_win_percent(spark, d):
    """melt -> win flag -> wins per (team, role) -> win % as a ratio of sums -> strength
    looked up for both teams of every game."""
    g = cut_lineage(games(spark, d), "games").withColumn("home_win", F.col("away_points") < F.col("home_points"))
    w = Rs.melt(g, ["home_win"], ["home_team", "away_team"], "is_home", "team")
    w = w.withColumn("win", (F.col("home_win") == (F.col("is_home") == "home_team")).cast("int"))
    wins = w.groupBy("team", "is_home").agg(F.sum("win").alias("n_wins"), F.count(F.lit(1)).alias("n_games"))
    # one row a team, used by both look-ups
    pct = cut_lineage(wins.groupBy("team").agg(ratio_of_sums("n_wins", "n_games").alias("pct")), "win-percent")
    out = J.lookup_map(g, "away_team", pct, "team", "pct", "away_strength")
    out = J.lookup_map(out, "home_team", pct, "team", "pct", "home_strength")
    return out.select("l_orderkey", "l_linenumber", stable_round("away_strength", 9).alias("away_strength"),
                      stable_round("home_strength", 9).alias("home_strength"),
                      (F.col("home_points") - F.col("away_points")).alias("point_diff"))


@register("flow_win_spread", sql="""
WITH g AS (SELECT s_nationkey::BIGINT AS away_team, c_nationkey::BIGINT AS home_team, l_tax * 500 < l_quantity AS home_win
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
h AS (SELECT home_team AS team, avg(home_win::INT) AS home FROM g GROUP BY 1),
a AS (SELECT away_team AS team, avg((NOT home_win)::INT) AS away FROM g GROUP BY 1)
SELECT team, round((home - away) + 5.123e-13, 9) AS spread, round(((home + away) / 2) + 5.123e-13, 9) AS overall
FROM h FULL JOIN a USING (team)""")
def flow_win_spread(spark, d):
    """Win % at home minus win % away, by team: one partial aggregation per (team, role), then unstacked."""
    g = games(spark, d).withColumn("home_win", F.col("away_points") < F.col("home_points"))
    w = Rs.melt(g, ["home_win"], ["home_team", "away_team"], "role", "team")
    pct = w.groupBy("team").pivot("role", ["home_team", "away_team"]).agg(F.avg((F.col("home_win") == (F.col("role") == "home_team")).cast("int")))
    return pct.select("team", stable_round(F.col("home_team") - F.col("away_team"), 9).alias("spread"),
                      stable_round((F.col("home_team") + F.col("away_team")) / 2, 9).alias("overall"))


@register("flow_rest_ma", sql="WITH" + _GAMES_SQL + """,
m AS (SELECT date, avg(rest) FILTER (WHERE variable = 'away_team') AS away_team,
             avg(rest) FILTER (WHERE variable = 'home_team') AS home_team FROM r GROUP BY date),
f AS (SELECT * FROM m WHERE away_team < 7)
SELECT date,
  CASE WHEN count(away_team) OVER w >= 7 THEN round((avg(away_team) OVER w) + 5.123e-10, 6) END AS away_rest_ma7,
  CASE WHEN count(home_team) OVER w >= 7 THEN round((avg(home_team) OVER w) + 5.123e-10, 6) END AS home_rest_ma7
FROM f WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def flow_rest_ma(spark, d):
    """Mean rest per (date, role) -> unstack roles -> keep away < 7 -> 7-row rolling mean."""
    r = tidy_rest(spark, d)
    wide = Rs.pivot(r, ["date"], "variable", ["away_team", "home_team"], F.avg("rest"))
    # One row per date (bounded by the calendar, not by the data): written once, so the
    # ordered window's sampling pass does not recompute the whole games pipeline.
    wide = cut_lineage(wide.filter(F.col("away_team") < 7), "rest-by-date")

    def build(w):
        fw = w.rowsBetween(-6, 0)
        return {f"{c[:4]}_rest_ma7": F.when(F.count(c).over(fw) >= 7, F.avg(c).over(fw)) for c in ("away_team", "home_team")}
    h = B.ordered_window(wide, [], ["date"], 6, 0, build)
    return h.select("date", stable_round("away_rest_ma7", 6).alias("away_rest_ma7"),
                    stable_round("home_rest_ma7", 6).alias("home_rest_ma7"))


# ---------------------------------------------------------------- E9

@register("flow_top_occupations", sql="""
WITH top AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 10)
SELECT p_brand, count(*) AS count, round((avg(p_retailprice)) + 5.123e-10, 6) AS mean_price,
       round((sum(p_retailprice)) + 5.123e-06, 2) AS sum_price FROM part WHERE p_brand IN (SELECT p_brand FROM top) GROUP BY 1""")
def flow_top_occupations(spark, d):
    """Column-pruned scan -> counts -> top 10 -> statistics of the top 10."""
    p = table(spark, d, "part", ["p_brand", "p_retailprice"])
    kept = filters.filter_isin_topk(p, "p_brand", 10)
    return kept.groupBy("p_brand").agg(F.count(F.lit(1)).alias("count"), stable_round(F.avg("p_retailprice"), 6).alias("mean_price"),
                                       stable_round(F.sum("p_retailprice"), 2).alias("sum_price"))


# ---------------------------------------------------------------- E10

@register("flow_party_donations", sql="""
WITH cm AS (SELECT c_custkey, last(c_mktsegment ORDER BY c_name) AS party FROM customer GROUP BY 1),
o AS (SELECT o_orderdate AS day, party, o_totalprice FROM orders JOIN cm ON o_custkey = c_custkey
      WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2000-01-01'),
w AS (SELECT day, sum(o_totalprice) FILTER (WHERE party = 'BUILDING') AS BUILDING,
             sum(o_totalprice) FILTER (WHERE party = 'MACHINERY') AS MACHINERY
      FROM o WHERE party IN ('BUILDING', 'MACHINERY') GROUP BY day),
p AS (SELECT *, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () AS n FROM w),
t AS (SELECT * FROM p WHERE i >= 1 AND i < n - 2)
SELECT day, round((avg(BUILDING) OVER r) + 5.123e-08, 4) AS building_30d, round((avg(MACHINERY) OVER r) + 5.123e-08, 4) AS machinery_30d
FROM t WINDOW r AS (ORDER BY day RANGE BETWEEN (INTERVAL 30 DAY - INTERVAL 1 MICROSECOND) PRECEDING AND CURRENT ROW)""")
def flow_party_donations(spark, d):
    """Date filter -> dimension (last name per id) -> join -> day x party sums -> keep two
    parties -> unstack -> drop first row and last two -> 30-day rolling mean."""
    o = table(spark, d, "orders", ["o_custkey", "o_orderdate", "o_totalprice"]).filter(
        (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") <= F.lit("2000-01-01").cast("timestamp_ntz")))
    cm = group_first(table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"]), ["c_custkey"],
                     ["c_mktsegment"], ["c_name"], last=True).withColumnRenamed("c_mktsegment", "party")
    j = J.join_small(o, cm, o["o_custkey"] == cm["c_custkey"])
    sums = j.groupBy(F.col("o_orderdate").alias("day"), "party").agg(F.sum("o_totalprice").alias("amt"))
    sums = sums.filter(F.col("party").isin("BUILDING", "MACHINERY"))
    wide = Rs.unstack(sums, ["day"], "party", "amt", ["BUILDING", "MACHINERY"])
    trimmed = positional_rows(wide, ["day"], 1, -2)
    day_us = 86_400_000_000
    r = B.rolling_time(trimmed, [], "day", ["BUILDING", "MACHINERY"], 30 * day_us, ["mean"], fmt="{value}_30d")
    return r.select("day", stable_round("BUILDING_30d", 4).alias("building_30d"),
                    stable_round("MACHINERY_30d", 4).alias("machinery_30d"))


# ---------------------------------------------------------------- E11

def _monthly_model_sql():
    from framewise.plans.stats import _MONTHLY_SQL, _ols_sql
    fitted = " + ".join(f"c{i} * x{i}" for i in range(7))
    return "WITH RECURSIVE" + _MONTHLY_SQL + """,
l AS (SELECT month, y, """ + ", ".join(f"lag(y, {k}) OVER (ORDER BY month) AS L{k}" for k in range(1, 6)) + """ FROM y),
x AS (SELECT y, 1.0 AS x0, (row_number() OVER (ORDER BY month) - 1)::DOUBLE AS x1, """ + ", ".join(
        f"L{k} AS x{k + 1}" for k in range(1, 6)) + """ FROM l WHERE L5 IS NOT NULL)""" + _ols_sql(7) + f""",
e0 AS (SELECT x1 AS trend, y - ({fitted}) AS e FROM x, cf),
e AS (SELECT trend, e - avg(e) OVER () AS e FROM e0),
k AS (SELECT unnest(generate_series(0, 36)) AS lag)
SELECT k.lag::BIGINT AS lag, round((sum(e1.e * e2.e) / (SELECT sum(e * e) FROM e)) + 5.123e-10, 6) AS acf
FROM k JOIN e e1 ON true JOIN e e2 ON e2.trend = e1.trend - k.lag GROUP BY k.lag"""


@register("flow_monthly_model", sql=_monthly_model_sql())
def flow_monthly_model(spark, d):
    """Daily counts -> monthly mean -> lags -> OLS (y ~ trend + L1..L5) -> ACF of its
    residuals (36 lags). The oracle solves the same least squares by Gauss-Jordan in SQL."""
    from framewise.operators import stats as M
    from framewise.operators.ordering import with_positions
    from framewise.plans.stats import monthly_series
    lagged = B.lags(monthly_series(spark, d), [], ["month"], "y", range(1, 6), fmt="L{k}").dropna()
    x = with_positions(lagged, ["month"], name="trend")
    xs = ["trend", "L1", "L2", "L3", "L4", "L5"]
    coef = M.ols(x, "y", xs).groupBy().pivot("term", ["Intercept", *xs]).agg(F.first("coef"))
    fitted = F.col("c_Intercept")
    for t in xs:
        fitted = fitted + F.col(f"c_{t}") * F.col(t)
    coef = coef.toDF(*[f"c_{c}" for c in coef.columns])
    resid = x.join(F.broadcast(coef), how="inner").withColumn("resid", F.col("y") - fitted)
    return M.acf(resid, "resid", ["trend"], nlags=36).withColumn("acf", stable_round("acf", 6))


# ---------------------------------------------------------------- E12

@register("flow_clean_flights", sql="""
WITH raw AS (SELECT event_id AS "EVENT_ID", strftime(ts, '%Y-%m-%d') AS "FL_DATE",
  upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ', ' || upper(substr(event_type, 1, 2)) AS "ORIGIN_CITY_NAME",
  CAST(CAST(CASE WHEN hour(ts) = 0 THEN 2400 + minute(ts) ELSE hour(ts) * 100 + minute(ts) END AS DOUBLE) AS VARCHAR) AS "DEP_TIME",
  event_type AS "UNIQUE_CARRIER" FROM events),
c AS (SELECT *, regexp_replace("DEP_TIME", '\\.0$', '') AS s FROM raw),
p AS (SELECT *, CASE WHEN length(s) < 4 THEN lpad(s, 4, '0') ELSE s END AS hhmm FROM c),
k AS (SELECT carrier, (dense_rank() OVER (ORDER BY carrier) - 1)::INTEGER AS carrier_code FROM (SELECT DISTINCT "UNIQUE_CARRIER" AS carrier FROM raw))
SELECT "EVENT_ID" AS event_id,
  CASE WHEN regexp_matches("ORIGIN_CITY_NAME", '(.*), \\w{2}') THEN regexp_extract("ORIGIN_CITY_NAME", '(.*), \\w{2}', 1) END AS origin_city_name,
  CASE WHEN length(hhmm) = 4 THEN try_strptime("FL_DATE" || ' ' || substr(hhmm, 1, 2) || ':' || substr(hhmm, 3, 2), '%Y-%m-%d %H:%M') END AS dep_time,
  carrier_code FROM p JOIN k ON p."UNIQUE_CARRIER" = k.carrier""")
def flow_clean_flights(spark, d):
    """Raw text columns -> lower-cased names -> city from "City, ST" -> hhmm text to
    timestamps (coerced) -> carrier category codes."""
    from framewise.plans.scalars import _dep_text, category_codes
    ev = table(spark, d, "events", ["event_id", "ts", "event_type"])
    raw = ev.select(F.col("event_id").alias("EVENT_ID"), F.date_format("ts", "yyyy-MM-dd").alias("FL_DATE"),
                    F.concat(F.initcap("event_type"), F.lit(", "), F.upper(F.substring("event_type", 1, 2))).alias("ORIGIN_CITY_NAME"),
                    _dep_text().alias("DEP_TIME"), F.col("event_type").alias("UNIQUE_CARRIER"))
    df = C.rename_columns(raw, str.lower)
    df = df.withColumn("origin_city_name", Tx.extract("origin_city_name", r"(.*), \w{2}"))
    df = C.map_columns(df, ["dep_time"], lambda c: D.hhmm_to_timestamp(F.col("fl_date"), c))
    df = category_codes(df, "unique_carrier", "carrier_code")
    return df.select("event_id", "origin_city_name", "dep_time", "carrier_code")


# ---------------------------------------------------------------- E13

@register("flow_nearest_pairs", sql="""
WITH s AS (SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
           ORDER BY md5(concat_ws('|', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR, '42')) LIMIT 500),
c AS (SELECT l_orderkey, l_linenumber,
  (((l_suppkey * 37) % 180) - 90)::DOUBLE AS lat_1, (((l_suppkey * 91) % 360) - 180)::DOUBLE AS lon_1,
  (((o_custkey * 37) % 180) - 90)::DOUBLE AS lat_2, (((o_custkey * 91) % 360) - 180)::DOUBLE AS lon_2
  FROM s JOIN orders ON l_orderkey = o_orderkey),
k AS (SELECT *, sin(radians(90 - lat_1)) * sin(radians(90 - lat_2)) * cos(radians(lon_1) - radians(lon_2))
              + cos(radians(90 - lat_1)) * cos(radians(90 - lat_2)) AS cosv FROM c)
SELECT l_orderkey, l_linenumber, round((acos(greatest(-1.0, least(1.0, cosv))) * 6373.0) + 5.123e-07, 3) AS distance_km FROM k""")
def flow_nearest_pairs(spark, d):
    """Sample shipments reproducibly, attach both endpoints' coordinates by equi-joins and
    compute the great-circle distance. (The reference's all-pairs product is not built.)"""
    from framewise.plans.scalars import key_lat, key_lon
    li = filters.sample_rows(table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]), 500,
                             ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], seed=42)
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    dist = great_circle(key_lat(F.col("l_suppkey")), key_lon(F.col("l_suppkey")), key_lat(F.col("o_custkey")), key_lon(F.col("o_custkey")))
    return j.select("l_orderkey", "l_linenumber", stable_round(dist, 3).alias("distance_km"))


@register("nearest_customers", sql="""
WITH s AS (SELECT s_suppkey, (((s_suppkey * 53) % 180) - 90 + 0.25)::DOUBLE AS lat, (((s_suppkey * 17) % 360) - 180 + 0.125)::DOUBLE AS lon FROM supplier),
c AS (SELECT c_custkey, (((c_custkey * 37) % 180) - 90)::DOUBLE AS lat, (((c_custkey * 91) % 360) - 180)::DOUBLE AS lon FROM customer),
v AS (SELECT s_suppkey, c_custkey,
  cos(radians(c.lat)) * sin(radians(c.lon - s.lon)) AS east,
  cos(radians(s.lat)) * sin(radians(c.lat)) - sin(radians(s.lat)) * cos(radians(c.lat)) * cos(radians(c.lon - s.lon)) AS north,
  sin(radians(s.lat)) * sin(radians(c.lat)) + cos(radians(s.lat)) * cos(radians(c.lat)) * cos(radians(c.lon - s.lon)) AS dot FROM s, c),
k AS (SELECT s_suppkey, c_custkey, round(atan2(sqrt(east * east + north * north), dot) * 6373.0, 6) AS distance_km FROM v)
SELECT s_suppkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY distance_km, c_custkey)::INTEGER AS rank, c_custkey, distance_km
FROM k QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY distance_km, c_custkey) <= 3""")
def nearest_customers(spark, d):
    """The three nearest customers of every supplier, over all rows of both."""
    from framewise.operators.spatial import nearest_places
    s = table(spark, d, "supplier", ["s_suppkey"])
    s = s.select("s_suppkey", ((F.col("s_suppkey") * 53) % 180 - 90 + 0.25).alias("lat"), ((F.col("s_suppkey") * 17) % 360 - 180 + 0.125).alias("lon"))
    c = table(spark, d, "customer", ["c_custkey"])
    c = c.select("c_custkey", ((F.col("c_custkey") * 37) % 180 - 90).alias("lat"), ((F.col("c_custkey") * 91) % 360 - 180).alias("lon"))
    near = nearest_places(s, c, 3, ("s_suppkey", "lat", "lon"), ("c_custkey", "lat", "lon"))
    return near.select(F.col("query_id").alias("s_suppkey"), "rank", F.col("point_id").alias("c_custkey"), F.col("distance").alias("distance_km"))
