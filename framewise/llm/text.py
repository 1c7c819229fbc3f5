"""Column helpers shared by the native operators: words, ASCII lower case, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_count(text: Column) -> Column:
    """Number of space-separated words (NULL counts 0)."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``translate`` maps character by character and is slow, so it runs only
    where ``lower`` would also change a letter outside A-Z."""
    return F.when(text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"), F.translate(text, _UPPER, _UPPER.lower())) \
        .otherwise(F.lower(text))


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit key of (doc_id, text). Rows that agree in both share it and get equal answers."""
    return F.xxhash64(doc_id, text)


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
