"""Skew-safe ordered windows.

A plain ``Window.partitionBy(key).orderBy(t)`` sends a whole key to one task; a key with
a third of the table makes that one task a third of the job. Here every ordered window
runs on bounded pieces instead:

1. ``with_positions`` numbers rows inside each key (balanced range chunks).
2. Rows are cut into blocks of ``block_rows`` consecutive positions per key.
3. Each row is also copied into the neighbouring block(s) as a *halo* when it lies
   within the frame's look-back (look-ahead) of the block edge.
4. The window runs partitioned by (key, block) -- at most ``block_rows`` + halo rows --
   and only home rows are kept.

Running (unbounded-preceding) aggregates add a per-block carry taken from a small table
of block totals. Time-range frames are cut into slices of time instead (``rolling_time``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.ordering import with_positions

DEFAULT_BLOCK_ROWS = 100_000
#: Slices of a time frame, at most: over so many tasks is a key spread.
MOST_SLICES = 256


def with_halo(p: DataFrame, pos: str, block_rows: int, lookback: int, lookahead: int) -> DataFrame:
    """Rows with their block ``_fw_blk`` of positions, and copies (``_fw_home`` false) of those that a neighbouring block looks at."""
    b = F.floor(F.col(pos) / block_rows)
    off = F.col(pos) - b * block_rows
    entries = [F.struct(b.alias("blk"), F.lit(True).alias("home"))]
    if lookback > 0:
        entries.append(F.when(off >= block_rows - lookback, F.struct((b + 1).alias("blk"), F.lit(False).alias("home"))))
    if lookahead > 0:
        entries.append(F.when((off < lookahead) & (b > 0), F.struct((b - 1).alias("blk"), F.lit(False).alias("home"))))
    arr = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return p.withColumn("_fw_e", F.explode(arr)).withColumn("_fw_blk", F.col("_fw_e.blk")).withColumn(
        "_fw_home", F.col("_fw_e.home")).drop("_fw_e")


def ordered_window(df: DataFrame, by: Sequence[str], order: Sequence, lookback: int, lookahead: int,
                   build: Callable[[Window], dict[str, Column]], block_rows: int = DEFAULT_BLOCK_ROWS,
                   keep_position: str | None = None) -> DataFrame:
    """Add the columns returned by ``build(w)``, where ``w`` is an ordered window spec whose
    frames may reach at most ``lookback`` rows back and ``lookahead`` rows ahead."""
    block_rows = max(block_rows, lookback + 1, lookahead + 1)  # a frame reaches into the next block at most
    by = list(by)
    p = with_positions(df, order, by, name="_fw_pos")
    blk = with_halo(p, "_fw_pos", block_rows, lookback, lookahead)
    w = Window.partitionBy(*by, "_fw_blk").orderBy("_fw_pos")
    out = blk.withColumns(build(w)).filter(F.col("_fw_home"))
    drop = ["_fw_blk", "_fw_home"] + ([] if keep_position else ["_fw_pos"])
    out = out.drop(*drop)
    return out.withColumnRenamed("_fw_pos", keep_position) if keep_position else out


def lags(df: DataFrame, by: Sequence[str], order: Sequence, value: str, ks: Sequence[int],
         fmt: str = "{value}_L{k}", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``shift(k)`` for each k (k=0 is the value itself)."""
    reach = max([k for k in ks if k > 0], default=0)
    return ordered_window(df, by, order, reach, 0, lambda w: {
        fmt.format(value=value, k=k): (F.col(value) if k == 0 else F.lag(value, k).over(w)) for k in ks},
        block_rows)


def rolling(df: DataFrame, by: Sequence[str], order: Sequence, value: str, n: int, aggs: Sequence[str],
            center: bool = False, min_periods: int | None = None, fmt: str = "{value}_{agg}{n}",
            block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``rolling(n)[.center].agg()`` on rows; NULL until ``min_periods`` (default n) non-NULL values."""
    lo, hi = (-(n // 2), n - n // 2 - 1) if center else (-(n - 1), 0)
    need = n if min_periods is None else min_periods
    fns = {"sum": F.sum, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count}

    def build(w):
        fw = w.rowsBetween(lo, hi)
        guard = F.count(F.col(value)).over(fw) >= need
        # count: NULL only while the frame holds fewer rows than min_periods, else the
        # number of non-NULL values (0 allowed)
        rows = F.count(F.lit(1)).over(fw) >= need
        return {fmt.format(value=value, agg=a, n=n): F.when(rows if a == "count" else guard, fns[a](F.col(value)).over(fw))
                for a in aggs}
    return ordered_window(df, by, order, -lo, hi, build, block_rows)


def running(df: DataFrame, by: Sequence[str], order: Sequence, value: str, aggs: Sequence[str] = ("mean",),
            fmt: str = "{value}_expanding_{agg}", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``expanding().agg()`` for sum / count / mean (NULLs skipped): a within-block running
    sum and count plus the carried totals of all earlier blocks of the key."""
    by = list(by)
    p = with_positions(df, order, by, name="_fw_pos").withColumn("_fw_blk", F.floor(F.col("_fw_pos") / block_rows))
    w = (Window.partitionBy(*by, "_fw_blk").orderBy("_fw_pos").rowsBetween(Window.unboundedPreceding, 0))
    p = p.withColumns({"_fw_s": F.sum(F.col(value)).over(w), "_fw_c": F.count(F.col(value)).over(w)})
    tot = p.groupBy(*by, "_fw_blk").agg(F.sum(F.col(value)).alias("_fw_bs"), F.count(F.col(value)).alias("_fw_bc"))
    wp = Window.partitionBy(*by).orderBy("_fw_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(*[F.col(b).alias(f"_fw_k{i}") for i, b in enumerate(by)], F.col("_fw_blk").alias("_fw_cb"),
                       F.coalesce(F.sum("_fw_bs").over(wp), F.lit(0)).alias("_fw_cs"),
                       F.coalesce(F.sum("_fw_bc").over(wp), F.lit(0)).alias("_fw_cc"))
    cond = F.col("_fw_blk") == F.col("_fw_cb")
    for i, b in enumerate(by):
        cond = cond & F.col(b).eqNullSafe(F.col(f"_fw_k{i}"))
    j = p.join(carry, cond, "inner")
    s = F.coalesce(F.col("_fw_s"), F.lit(0)) + F.col("_fw_cs")
    c = F.col("_fw_c") + F.col("_fw_cc")
    outs = {"sum": F.when(c > 0, s), "count": c, "mean": F.when(c > 0, s / c)}
    return j.select(*df.columns, *[outs[a].alias(fmt.format(value=value, agg=a)) for a in aggs])


def fill_forward(df: DataFrame, by: Sequence[str], order: Sequence, value: str, name: str,
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``ffill()``: the latest non-NULL value up to the row. Inside a block by a window; a block that
    begins with NULLs takes the last value of the blocks before it from a table of one row a block."""
    by = list(by)
    p = with_positions(df, order, by, name="_fw_pos").withColumn("_fw_blk", F.floor(F.col("_fw_pos") / block_rows))
    w = Window.partitionBy(*by, "_fw_blk").orderBy("_fw_pos").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("_fw_last", F.last(F.col(value), ignorenulls=True).over(w))
    ends = p.groupBy(*by, "_fw_blk").agg(F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col("_fw_pos"))).alias("_fw_end"))
    wp = Window.partitionBy(*by).orderBy("_fw_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*[F.col(b).alias(f"_fw_k{i}") for i, b in enumerate(by)], F.col("_fw_blk").alias("_fw_cb"),
                        F.last("_fw_end", ignorenulls=True).over(wp).alias("_fw_before"))
    cond = F.col("_fw_blk") == F.col("_fw_cb")
    for i, b in enumerate(by):
        cond = cond & F.col(b).eqNullSafe(F.col(f"_fw_k{i}"))
    return p.join(carry, cond, "inner").select(*df.columns, F.coalesce("_fw_last", "_fw_before").alias(name))


def _slices(length: int, most: int = MOST_SLICES) -> int:
    """Into how many equal slices a frame is cut: the largest divisor of its length up to ``most``."""
    return max(n for n in range(1, most + 1) if length % n == 0)


def rolling_time(df: DataFrame, by: Sequence[str], ts: str, value: str | Sequence[str], length_micros: int,
                 aggs: Sequence[str] = ("mean",), fmt: str = "{value}_{agg}_t", slices: int | None = None) -> DataFrame:
    """``rolling("30D").agg()``: frame (t - L, t], at least one value; rows of one time see each other.

    Time is cut into slices, S to a frame. A frame is then S - 1 whole slices and two parts that together
    are as long as one slice: its own slice up to t, and slice b - S after t - L. Slices of one residue modulo
    S are put end to end on a time of their own, where slice b - S stands right before slice b, so that
    both parts are one range frame of a slice's length over (key, residue): a key is spread over S tasks, no row
    is copied, and a frame holds 1 / S of the rows. Whole slices are aggregated once, to one row each, and the S - 1
    before each are merged by window. Means and deviations merge as (count, mean, sum of squares about
    the mean), so values far from zero lose no digits.

    NULL values are skipped; a NULL key is a key; a row without time gets NULLs. ``count`` is 0 in a frame without values,
    the others are NULL. Several value columns share the passes."""
    values = [value] if isinstance(value, str) else list(value)
    by, S = list(by), slices or _slices(length_micros)
    if length_micros < 1 or length_micros % S:
        raise ValueError("slices must divide the length of the frame")
    unknown = set(aggs) - {"sum", "mean", "std", "min", "max", "count"}
    if unknown:
        raise ValueError(f"unknown aggregates {sorted(unknown)}")
    width = length_micros // S
    squares = "std" in aggs
    x = df.withColumn("_fw_us", F.unix_micros(F.col(ts).cast("timestamp")))
    x = x.withColumn("_fw_in", F.pmod("_fw_us", F.lit(width))).withColumn("_fw_sl", F.expr(f"(_fw_us - _fw_in) div {width}"))
    x = x.withColumn("_fw_r", F.pmod("_fw_sl", F.lit(S))).withColumn("_fw_u", F.expr(f"((_fw_sl - _fw_r) div {S}) * {width} + _fw_in"))

    def parts(v: str, over: Callable[[Column], Column]) -> Column:
        """What is known of a set of values and can be merged."""
        c = F.col(v)
        fields = [over(F.count(c)).alias("n")]
        if {"mean", "std"} & set(aggs):
            fields.append(over(F.avg(c.cast("double"))).alias("mean"))
        if squares:
            fields.append((over(F.var_pop(c.cast("double"))) * over(F.count(c))).alias("m2"))
        return F.struct(*fields, *[over(f(c)).alias(a) for a, f in (("sum", F.sum), ("min", F.min), ("max", F.max)) if a in aggs])

    def merged(a: Column, b: Column) -> Column:
        """Of two sets, either of them without values."""
        n = a["n"] + b["n"]
        fields = [n.alias("n")]
        if {"mean", "std"} & set(aggs):
            gap = b["mean"] - a["mean"]
            fields.append(F.when(a["n"] == 0, b["mean"]).when(b["n"] == 0, a["mean"]).otherwise(a["mean"] + gap * b["n"] / n).alias("mean"))
            if squares:
                fields.append(F.when(a["n"] == 0, b["m2"]).when(b["n"] == 0, a["m2"])
                              .otherwise(a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"))
        if "sum" in aggs:
            fields.append(F.when(a["n"] == 0, b["sum"]).when(b["n"] == 0, a["sum"]).otherwise(a["sum"] + b["sum"]).alias("sum"))
        return F.struct(*fields, *[f(a[c], b[c]).alias(c) for c, f in (("min", F.least), ("max", F.greatest)) if c in aggs])

    edge = Window.partitionBy(*by, "_fw_r").orderBy("_fw_u").rangeBetween(-(width - 1), 0)
    x = x.withColumns({f"_fw_p{i}": parts(v, lambda agg: agg.over(edge)) for i, v in enumerate(values)})
    if S > 1:
        whole = (df.withColumn("_fw_us", F.unix_micros(F.col(ts).cast("timestamp"))).where(F.col("_fw_us").isNotNull())
                 .withColumn("_fw_sl", F.expr(f"(_fw_us - pmod(_fw_us, {width})) div {width}"))
                 .groupBy(*by, "_fw_sl").agg(*[parts(v, lambda agg: agg).alias(f"_fw_w{i}") for i, v in enumerate(values)]))
        before = Window.partitionBy(*by).orderBy("_fw_sl").rangeBetween(-(S - 1), -1)
        none = lambda i: F.from_json(F.lit('{"n":0}'), whole.schema[f"_fw_w{i}"].dataType)
        whole = whole.select(*[F.col(b).alias(f"_fw_k{j}") for j, b in enumerate(by)], F.col("_fw_sl").alias("_fw_ws"), *[
            F.aggregate(F.collect_list(f"_fw_w{i}").over(before), none(i), merged).alias(f"_fw_w{i}") for i in range(len(values))])
        on = F.col("_fw_sl") == F.col("_fw_ws")
        for j, b in enumerate(by):
            on = on & F.col(b).eqNullSafe(F.col(f"_fw_k{j}"))
        x = x.join(whole, on, "left")
        x = x.withColumns({f"_fw_p{i}": merged(F.col(f"_fw_p{i}"), F.col(f"_fw_w{i}")) for i in range(len(values))})
    timed = F.col("_fw_us").isNotNull()

    def result(i: int, a: str) -> Column:
        p = F.col(f"_fw_p{i}")
        if a == "std":
            return F.when(timed & (p["n"] > 1), F.sqrt(p["m2"] / (p["n"] - 1)))
        return F.when(timed, p["n"]) if a == "count" else F.when(timed & (p["n"] > 0), p[a])
    return x.select(*df.columns, *[result(i, a).alias(fmt.format(value=v, agg=a)) for i, v in enumerate(values) for a in aggs])


def rank_average(df: DataFrame, by: Sequence[str], value: str, tie_break: Sequence[str], name: str = "rank") -> DataFrame:
    """Average rank of ``value`` within ``by`` (ties share the mean of their ranks):
    first position of the tie run + (run length - 1) / 2 + 1, from positions and one
    partial aggregation per (group, value)."""
    by = list(by)
    nulls = df.filter(F.col(value).isNull()).select(*df.columns, F.lit(None).cast("double").alias(name))
    df = df.filter(F.col(value).isNotNull())
    p = with_positions(df, [value, *tie_break], by, name="_fw_pos")
    runs = p.groupBy(*by, value).agg(F.min("_fw_pos").alias("_fw_first"), F.count(F.lit(1)).alias("_fw_ties"))
    keys = by + [value]
    r = runs.select(*[F.col(k).alias(f"_fw_k{i}") for i, k in enumerate(keys)], "_fw_first", "_fw_ties")
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"_fw_k{i}"))
        cond = c if cond is None else cond & c
    j = p.join(r, cond, "inner")
    ranked = j.select(*df.columns, (F.col("_fw_first") + 1 + (F.col("_fw_ties") - 1) / 2.0).alias(name))
    return ranked.unionByName(nulls)


def previous_leading(df: DataFrame, by: Sequence[str], lead: str, tie_break: Sequence[str],
                     name: str = "prev") -> DataFrame:
    """``lag(lead, 1)`` in the order (lead, *tie_break) within ``by``, without sorting rows.

    Within a tie set of equal (group, lead), only the first row (smallest tie-break, which
    must be unique) looks back to the group's previous distinct ``lead`` value; every other
    row's previous row has the same ``lead``. So one partial aggregation to distinct
    (group, lead) pairs, a skew-safe lag on that much smaller table, and one join back
    (AQE broadcasts it when small) replace a lag over all rows -- worthwhile when ``lead``
    is coarse (a date per team), not when (group, lead) is nearly unique. The pairs table
    holds one row per distinct ``lead`` of a group (at most the calendar's days for a
    date), so its lag is a plain window partitioned by the group."""
    by = list(by)
    tb = F.struct(*[F.col(c) for c in tie_break])
    pairs = df.groupBy(*by, lead).agg(F.min(tb).alias("_fw_first"))
    pairs = pairs.withColumn("_fw_prevd", F.lag(lead, 1).over(Window.partitionBy(*by).orderBy(lead)))
    keys = [*by, lead]
    right = pairs.select(*[F.col(k).alias(f"_fw_k{i}") for i, k in enumerate(keys)], "_fw_first", "_fw_prevd")
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"_fw_k{i}"))
        cond = c if cond is None else cond & c
    j = df.join(right, cond, "inner")
    prev = F.when(tb == F.col("_fw_first"), F.col("_fw_prevd")).otherwise(F.col(lead))
    return j.select(*df.columns, prev.alias(name))
