"""Projection and schema operators (column subsets, renames, derived columns)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from framewise.operators.ordering import with_positions
from framewise.session import cut_lineage


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str] | Callable[[str], str]) -> DataFrame:
    """``rename(columns=dict)`` or ``rename(str.lower)``; unmatched names are kept."""
    if callable(mapping):
        return df.toDF(*[mapping(c) for c in df.columns])
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def assign(df: DataFrame, **exprs) -> DataFrame:
    """``assign(new=lambda df: ...)``: each later expression sees the earlier columns."""
    for name, e in exprs.items():
        df = df.withColumn(name, e(df) if callable(e) else e)
    return df


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def add_suffix(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(c + suffix) for c in df.columns])


def select_numeric(df: DataFrame) -> DataFrame:
    """``select_dtypes(np.number)``."""
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)])


def set_keys(df: DataFrame, keys: Sequence[str], names: Mapping[str, str] | None = None) -> DataFrame:
    """``set_index`` / ``reset_index`` / ``rename_axis``: key columns move first, optionally renamed.
    There is no hidden index; keys are ordinary columns."""
    names = names or {}
    rest = [c for c in df.columns if c not in keys]
    return df.select(*[F.col(k).alias(names.get(k, k)) for k in keys], *rest)


def conditional_update(df: DataFrame, mask: Column, column: str, value: Column) -> DataFrame:
    """``df.loc[mask, column] = value``; rows outside the mask keep their value."""
    return df.withColumn(column, F.when(F.coalesce(mask, F.lit(False)), value).otherwise(F.col(column)))


def where_mask(df: DataFrame, cond: Column, cols: Sequence[str], inverse: bool = False) -> DataFrame:
    """``.where(cond)`` keeps values where cond holds, else NULL; ``.mask(cond)`` the inverse."""
    keep = F.coalesce(cond, F.lit(False))
    if inverse:
        keep = ~keep
    return df.withColumns({c: F.when(keep, F.col(c)) for c in cols})


def update_from(df: DataFrame, new: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """``df.loc[new.index, column] = new``: rows whose key appears in ``new`` take its value
    (even a NULL one); a matched flag, not coalesce, decides."""
    upd = new.select(*key, F.col(column).alias("_fw_new"), F.lit(True).alias("_fw_hit"))
    out = df.join(upd, list(key), "left")
    return (out.withColumn(column, F.when(F.col("_fw_hit"), F.col("_fw_new")).otherwise(F.col(column)))
            .select(*df.columns))


def map_columns(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """``df[cols].apply(f)`` for a column function ``f``."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def category_values(df: DataFrame, column: str, max_values: int = 10_000) -> list:
    """Sorted distinct values of a category column (a small dimension). Refuses to pull an
    unbounded list to the driver."""
    vals = (df.select(column).where(F.col(column).isNotNull()).distinct()
            .orderBy(column).limit(max_values + 1).collect())
    if len(vals) > max_values:
        raise ValueError(f"{column} has more than {max_values} distinct values")
    return [r[0] for r in vals]


def one_hot(df: DataFrame, cols: Sequence[str], values: Mapping[str, Sequence] | None = None,
            drop_first: bool = True, prefix_sep: str = "_") -> DataFrame:
    """``get_dummies(drop_first=True)``: one 0/1 integer column per value (sorted), the first
    value dropped; a NULL cell gives 0 everywhere; the source column is replaced."""
    values = dict(values or {})
    for c in cols:
        vals = list(values.get(c) or category_values(df, c))
        if drop_first:
            vals = vals[1:]
        pos = df.columns.index(c)
        dummies = [F.when(F.col(c) == F.lit(v), 1).otherwise(0).cast("int").alias(f"{c}{prefix_sep}{v}")
                   for v in vals]
        rest = [F.col(x) for x in df.columns if x != c]
        df = df.select(*rest[:pos], *rest[pos:], *dummies)
    return df


def one_hot_sparse(df: DataFrame, column: str, name: str) -> tuple[DataFrame, DataFrame]:
    """``get_dummies`` for any number of categories: ``df`` with a sparse vector ``name`` (``size``, ``indices``, ``values``)
    in place of a column for each value, and the dictionary (``column``, ``code``) that says what the places mean.

    The distinct values are numbered in range chunks, in sorted order, and stay distributed; only their number reaches the
    driver. A NULL cell has no place set."""
    cats = df.select(F.col(f"`{column}`")).where(F.col(f"`{column}`").isNotNull()).distinct()
    dictionary = cut_lineage(with_positions(cats, [column], name="code").select(column, F.col("code").cast("int").alias("code")), "categories")
    look_up = dictionary.select(F.col(column).alias("_fw_value"), F.col("code").alias("_fw_code"))
    out = df.join(look_up, F.col(f"`{column}`") == F.col("_fw_value"), "left")
    places = F.array_compact(F.array("_fw_code"))
    vector = F.struct(F.lit(dictionary.count()).cast("int").alias("size"), places.alias("indices"),
                      F.transform(places, lambda _: F.lit(1.0)).alias("values"))
    return out.withColumn(name, vector).drop("_fw_value", "_fw_code"), dictionary


def drop_empty_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep only those of ``cols`` whose sum is > 0 (a data-dependent projection): one
    aggregate row decides, then a plain select."""
    sums = df.agg(*[F.sum(F.col(c)).alias(c) for c in cols]).first()
    keep = [c for c in df.columns if c not in cols or (sums[c] is not None and sums[c] > 0)]
    return df.select(*keep)


def replace_values(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    """``replace({old: new})``: unmatched values kept."""
    expr = None
    for old, new in mapping.items():
        expr = (F.when(F.col(column) == F.lit(old), F.lit(new)) if expr is None
                else expr.when(F.col(column) == F.lit(old), F.lit(new)))
    return df.withColumn(column, expr.otherwise(F.col(column)) if expr is not None else F.col(column))
