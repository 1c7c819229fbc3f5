"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius (km) used by the great-circle recipe.
EARTH_RADIUS_KM = 6373.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def great_circle(lat1, lng1, lat2, lng2, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance from degrees: the angle between the two position vectors, as atan2 of the
    lengths of their cross and dot products, which is exact for near and for opposite points."""
    a, b, turn = F.radians(_c(lat1)), F.radians(_c(lat2)), F.radians(_c(lng2) - _c(lng1))
    east = F.cos(b) * F.sin(turn)
    north = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(turn)
    dot = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(turn)
    return F.atan2(F.sqrt(east * east + north * north), dot) * F.lit(radius)


def fahrenheit_to_celsius(x) -> Column:
    return (_c(x) - 32) * 5 / 9


def round_half_even(x, digits: int = 0) -> Column:
    """NumPy-style rounding (ties to even); Spark's ``round`` rounds ties up."""
    return F.bround(_c(x), digits)


def tie_offset(digits: int) -> float:
    """Fixed nudge below the last kept digit. Exact decimal ties (a mean of exactly
    x.xxxxxx5) round up in Spark (decimal HALF_UP) but may round down elsewhere (binary
    ``round``); nudging both sides by the same tiny amount removes the tie."""
    return float(f"5.123e-{digits + 4}")


def stable_round(x, digits: int = 6) -> Column:
    """``round`` for published results that must agree digit-for-digit with another engine."""
    return F.round(_c(x) + F.lit(tie_offset(digits)), digits)


def stable_round_sql(expr: str, digits: int = 6) -> str:
    """The same normalisation written as SQL text (for the oracle queries)."""
    return f"round(({expr}) + {tie_offset(digits)!r}, {digits})"


def random_bits(seed: str, *keys) -> Column:
    """32 random bits for each row, by the digest of its keys and ``seed``: the same on every run, for any partitioning
    of the table and after a task runs again, unlike ``rand``. NULL keys are empty text; equal keys draw equal bits."""
    text = F.concat_ws("|", *[F.coalesce(_c(k).cast("string"), F.lit("")) for k in keys], F.lit(seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def random_uniform(seed: str, *keys) -> Column:
    """Uniform in the open interval from 0 to 1, by ``random_bits``."""
    return (random_bits(seed, *keys) + 0.5) / 2.0 ** 32


def random_normal(seed: str, *keys) -> Column:
    """Standard normal: the radius from one uniform value, the angle from another."""
    return F.sqrt(-2 * F.log(random_uniform(f"{seed}-radius", *keys))) * F.cos(2 * F.pi() * random_uniform(f"{seed}-angle", *keys))
