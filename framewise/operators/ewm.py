"""Exponentially weighted mean (``ewm(alpha).mean()``, adjust=True) without a row loop.

With d = 1 - alpha, the answer at row t is  sum_j x_j d^(t-j) / sum_j d^(t-j)  over the
non-NULL x_j with j <= t (a NULL row still ages the weights). Rows are numbered per
series (``with_positions``) and cut into blocks of B rows, B chosen so d^-B <= 1e12:

* inside a block, both sums are running sums of x_j d^-j' (j' = row in block) rescaled
  by d^t' -- a window bounded by B rows;
* the part from earlier blocks is a carry C_b = sum_k T_(b-k) d^((k-1)B) over the block
  totals T: the same sum again, over blocks instead of rows, with decay d^B. So blocks are cut
  into blocks of blocks in the same way, and so on, one small window a level, until a block
  decays so far that the last ``MOST_LAGS`` hold everything a double can show. No answer is cut short, and
  the plan's size grows with the logarithm of 1 / alpha.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.blocked import fill_forward, ordered_window
from framewise.operators.ordering import with_positions

#: A block's weights span 12 digits, and it holds so many rows at most.
SPAN = 12 * math.log(10)
BLOCK_ROWS = 1_000_000
#: A weight below exp(-GONE) is 0 in a double; decays of more than GONE / MOST_LAGS a step are summed lag by lag.
GONE = 745.0
MOST_LAGS = 64


def _on(left: str, right: str, by: Sequence[str]) -> Column:
    on = F.col(left) == F.col(right)
    for i, b in enumerate(by):
        on = on & F.col(b).eqNullSafe(F.col(f"_fw_k{i}"))
    return on


def _renamed(by: Sequence[str]) -> list[Column]:
    return [F.col(b).alias(f"_fw_k{i}") for i, b in enumerate(by)]


def _carries(totals: DataFrame, by: list[str], at: str, sums: Sequence[str], decay: float, block_rows: int) -> DataFrame:
    """(by, ``at``, sums): for each row, numbered 0, 1, ... by ``at``, sum_(k >= 1) of the sum k rows before it times
    exp(-decay (k - 1)); ``decay`` is above 0."""
    if decay * MOST_LAGS >= GONE:
        lags = [k for k in range(1, math.ceil(GONE / decay) + 2) if decay * (k - 1) < GONE]

        def direct(w: Window) -> dict[str, Column]:
            return {f"_fw_c_{s}": sum((F.coalesce(F.lag(s, k).over(w), F.lit(0.0)) * math.exp(-decay * (k - 1)) for k in lags), F.lit(0.0)) for s in sums}
        out = ordered_window(totals, by, [at], len(lags), 0, direct)
        return out.select(*by, at, *[F.col(f"_fw_c_{s}").alias(s) for s in sums])
    size = max(2, min(block_rows, int(SPAN / decay)))
    sup, inside = f"{at}s", f"{at}j"
    x = totals.withColumn(sup, F.floor(F.col(at) / size)).withColumn(inside, F.col(at) - F.col(sup) * size)
    up, down = F.exp(F.col(inside) * decay), F.exp(-(F.col(inside) - 1) * decay)
    before = Window.partitionBy(*by, sup).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inner = {f"_fw_i_{s}": F.coalesce(F.sum(F.col(s) * up).over(before), F.lit(0.0)) * down for s in sums}
    whole = x.groupBy(*by, sup).agg(*[(F.sum(F.col(s) * up) * math.exp(-(size - 1) * decay)).alias(s) for s in sums])
    above = _carries(whole, by, sup, sums, decay * size, block_rows)
    above = above.select(*_renamed(by), F.col(sup).alias("_fw_above"), *[F.col(s).alias(f"_fw_a_{s}") for s in sums])
    aged = F.exp(-F.col(inside) * decay)
    return (x.withColumns(inner).join(above, _on(sup, "_fw_above", by))
            .select(*by, at, *[(F.col(f"_fw_i_{s}") + F.col(f"_fw_a_{s}") * aged).alias(s) for s in sums]))


def ewm_mean(df: DataFrame, value: str, order: Sequence, by: Sequence[str] = (), alpha: float = 0.5,
             name: str | None = None, block_rows: int | None = None) -> DataFrame:
    """Adds ``name``. NULL values age the weights; rows before a series' first value get NULL. ``order`` must be
    unique in each series. ``block_rows`` bounds the blocks of every level."""
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be in (0, 1]")
    by = list(by)
    name = name or f"{value}_ewm"
    if alpha == 1:
        return fill_forward(df, by, order, value, name)  # weights 0^(t-j): the latest non-NULL value
    decay = -math.log1p(-alpha)
    most = block_rows or BLOCK_ROWS
    size = max(1, min(most, int(SPAN / decay)))

    p = with_positions(df, order, by, name="_fw_pos")
    p = p.withColumn("_fw_b", F.floor(F.col("_fw_pos") / size)).withColumn("_fw_j", F.col("_fw_pos") - F.col("_fw_b") * size)
    x = F.col(value).cast("double")
    up, down = F.exp(F.col("_fw_j") * decay), F.exp(-F.col("_fw_j") * decay)
    p = p.withColumn("_fw_xn", F.when(x.isNotNull(), x * up).otherwise(F.lit(0.0))).withColumn(
        "_fw_xd", F.when(x.isNotNull(), up).otherwise(F.lit(0.0)))
    w = Window.partitionBy(*by, "_fw_b").orderBy("_fw_pos").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("_fw_ln", F.sum("_fw_xn").over(w) * down).withColumn("_fw_ld", F.sum("_fw_xd").over(w) * down)

    # block totals aged to the start of the next block
    age = math.exp(-size * decay)
    totals = p.groupBy(*by, "_fw_b").agg((F.sum("_fw_xn") * age).alias("_fw_n"), (F.sum("_fw_xd") * age).alias("_fw_d"))
    carry = _carries(totals, by, "_fw_b", ["_fw_n", "_fw_d"], decay * size, most)
    carry = carry.select(*_renamed(by), F.col("_fw_b").alias("_fw_cb"), F.col("_fw_n").alias("_fw_cn"), F.col("_fw_d").alias("_fw_cd"))
    j = p.join(carry, _on("_fw_b", "_fw_cb", by), "inner")
    num = F.col("_fw_ln") + F.col("_fw_cn") * down
    den = F.col("_fw_ld") + F.col("_fw_cd") * down
    return j.select(*df.columns, F.when(den > 0, num / den).alias(name))
