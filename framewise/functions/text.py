"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def extract(x, pattern: str, group: int = 1) -> Column:
    """``str.extract``: the regex group, or NULL when the pattern does not match."""
    c = _c(x)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def strip_trailing_zero_decimal(x) -> Column:
    """``astype(str)`` of a float-ish value without its ``.0``."""
    return F.regexp_replace(_c(x).cast("string"), r"\.0$", "")


def pad_left(x, width: int, fill: str = "0") -> Column:
    """``str.pad(width, fillchar)``: pads shorter text, never truncates longer text
    (``lpad`` alone would cut it)."""
    c = _c(x)
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def slice_text(x, start: int, stop: int) -> Column:
    """``str[start:stop]`` (0-based, stop exclusive)."""
    return F.substring(_c(x), start + 1, stop - start)


def clean_case(x) -> Column:
    """``str.lower().str.strip()``."""
    return F.lower(F.trim(_c(x)))


def percent(x, digits: int = 2) -> Column:
    """``"{:.2%}".format(x)``."""
    return F.format_string(f"%.{digits}f%%", _c(x) * 100)
