"""Wide/long reshaping: melt, pivot, unstack, stack, JSON flattening, binning."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var_name: str = "variable",
         value_name: str = "value") -> DataFrame:
    """``melt(id_vars, value_vars, var_name, value_name)`` -- a narrow Expand, no shuffle."""
    return df.unpivot(list(ids), list(values), var_name, value_name)


def stack(df: DataFrame, ids: Sequence[str], values: Sequence[str], var_name: str = "variable",
          value_name: str = "value") -> DataFrame:
    """``stack()``: like melt but NULL cells are dropped."""
    return melt(df, ids, values, var_name, value_name).filter(F.col(value_name).isNotNull())


def pivot(df: DataFrame, index: Sequence[str], column: str, values: Sequence, agg: Column,
          fmt: str = "{v}") -> DataFrame:
    """``pivot_table(index, columns, values, aggfunc)`` with an explicit value list, so the
    schema is stable and no extra job looks for the values. One partial+final aggregation.
    Columns whose every cell is NULL stay (their values were asked for); rows exist only
    for observed index values. A value that is not listed raises when the rows are computed."""
    kind = df.schema[column].dataType
    unlisted = F.raise_error(F.concat(F.lit(f"pivot of {column}: value not listed: "), F.col(column).cast("string"))).cast(kind)
    checked = F.when(F.col(column).isNull() | F.col(column).isin(list(values)), F.col(column)).otherwise(unlisted)
    g = df.withColumn(column, checked).groupBy(*index).pivot(column, list(values)).agg(agg)
    return g.toDF(*index, *[fmt.format(v=v) for v in values])


def unstack(df: DataFrame, index: Sequence[str], key: str, value: str, keys: Sequence,
            fill=None, fmt: str = "{v}") -> DataFrame:
    """``unstack(key)``: one cell per (index, key) pair moves into a column per key;
    absent pairs are NULL or ``fill``."""
    out = pivot(df, index, key, keys, F.first(F.col(value), ignorenulls=True), fmt)
    if fill is not None:
        out = out.fillna(fill, subset=[fmt.format(v=v) for v in keys])
    return out


def flatten_struct(df: DataFrame, column: str, sep: str = ".") -> DataFrame:
    """``json_normalize``: nested struct fields become flat ``a.b.c`` columns."""
    def walk(prefix: str, path: Column, dtype) -> list[Column]:
        if isinstance(dtype, StructType):
            out = []
            for f in dtype.fields:
                out += walk(f"{prefix}{sep}{f.name}" if prefix else f.name, path.getField(f.name), f.dataType)
            return out
        return [path.alias(prefix)]
    dtype = df.schema[column].dataType
    rest = [F.col(c) for c in df.columns if c != column]
    return df.select(*rest, *walk("", F.col(column), dtype))


def flatten_all(df: DataFrame, sep: str = ".") -> DataFrame:
    """``json_normalize(records)``: top-level fields keep their names, nested struct fields
    become ``parent<sep>child`` columns, at any depth."""
    def walk(prefix: str, path: Column, dtype) -> list[Column]:
        if isinstance(dtype, StructType):
            out = []
            for f in dtype.fields:
                out += walk(f"{prefix}{sep}{f.name}", path.getField(f.name), f.dataType)
            return out
        return [path.alias(prefix)]
    cols = []
    for f in df.schema.fields:
        cols += walk(f.name, F.col(f"`{f.name}`"), f.dataType)
    return df.select(*cols)


def json_normalize(df: DataFrame, column: str, schema: StructType | str, sep: str = ".") -> DataFrame:
    """Parse a JSON text column with a declared schema, then flatten it."""
    parsed = df.withColumn(column, F.from_json(F.col(column), schema))
    return flatten_struct(parsed, column, sep)


# The types of variants that have another name, or no use, as the type of a column.
_VARIANT_TYPE = re.compile(r"`(?:[^`]|``)*`|OBJECT<|\bVOID\b|DECIMAL\(\d+, ?\d+\)")
_COLUMN_TYPE = {"OBJECT<": "STRUCT<", "VOID": "STRING"}


def variant_column_type(variant_type: str) -> DataType:
    """The column type for a type as ``schema_of_variant_agg`` names it: objects are structs, numbers with a
    point are doubles, a field that is always null is text, and fields of mixed types stay variants."""
    def rename(m: re.Match) -> str:
        if m[0].startswith("`"):
            return m[0]
        return _COLUMN_TYPE.get(m[0], "DOUBLE")
    return DataType.fromDDL(_VARIANT_TYPE.sub(rename, variant_type))


def _variant_step(name: str) -> str:
    if '"' not in name:
        return f'["{name}"]'
    if "'" not in name:
        return f"['{name}']"
    raise ValueError(f"a field whose name holds both kinds of quotes has no path: {name}")


def json_normalize_variant(df: DataFrame, column: str, sep: str = ".", max_fields: int = 10_000) -> DataFrame:
    """``json_normalize`` of JSON text whose fields nobody declared: one aggregation merges the types of all
    records, then each leaf field is read by its path into a column ``a.b.c``, in the order of names.

    Fields that a record lacks are NULL, and so are all fields of text that is NULL, not JSON or not an object.
    Integers of different sizes widen, integers with fractions make doubles; a field of other mixed types comes as
    its JSON text. Arrays stay arrays. An object that is empty in all records makes no column. The merged type is the
    only thing that reaches the driver; more than ``max_fields`` leaf fields, or two that would share a
    column name, raise (declare them: ``json_normalize``)."""
    taken = {c.lower() for c in df.columns if c != column}
    parsed = df.withColumn(column, F.try_parse_json(F.col(f"`{column}`")))
    record = F.col(f"`{column}`")
    is_object = F.schema_of_variant(record).startswith("OBJECT<")
    merged = parsed.agg(F.schema_of_variant_agg(F.when(is_object, record))).first()[0]
    if not merged.startswith("OBJECT<"):   # no record is an object
        return df.drop(column)

    def leaves(kind: DataType, name: str, path: str) -> list[tuple[str, str, DataType]]:
        if not isinstance(kind, StructType):
            return [(name, path, kind)]
        return [leaf for f in kind.fields
                for leaf in leaves(f.dataType, f"{name}{sep}{f.name}" if name else f.name, path + _variant_step(f.name))]

    found = leaves(variant_column_type(merged), "", "$")
    if len(found) > max_fields:
        raise ValueError(f"{len(found)} fields, more than {max_fields}: declare the schema")
    columns = []
    for name, path, kind in found:
        if name.lower() in taken:
            raise ValueError(f"two columns would be called {name}: choose another separator or rename")
        taken.add(name.lower())
        if kind.simpleString() == "variant":
            value = F.to_json(F.try_variant_get(record, path, "variant"))
        else:
            value = F.try_variant_get(record, path, kind.simpleString())
        columns.append(value.alias(name))
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    return parsed.select(*rest, *columns)


def bin_cut(x: str | Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """``cut(x, bins, labels)``: right-closed bins (lo, hi]; a value equal to the lowest
    edge, or outside all bins, is NULL. One label for each bin."""
    c = F.col(x) if isinstance(x, str) else x
    if labels is not None and len(labels) != len(edges) - 1:
        raise ValueError(f"{len(edges) - 1} bins need as many labels, not {len(labels)}")
    labels = list(labels) if labels is not None else [f"({lo}, {hi}]" for lo, hi in zip(edges, edges[1:])]
    expr = None
    for lo, hi, lab in zip(edges, edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr
