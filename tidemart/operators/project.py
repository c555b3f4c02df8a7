"""Projections and predicates (P1-P7).

All of these are single ``select`` / ``filter`` steps: Catalyst collapses them,
prunes columns down to the parquet scan and pushes the predicates into it.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions.columns import date_text


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1 + P3 + F7 + F8 -------------------------------------------------------------
def transfer_projection(source: DataFrame, target_schema: StructType,
                        constants: Mapping[str, object] | None = None,
                        date_column: str | None = "report_dt",
                        date_length: int = 10) -> DataFrame:
    """Project ``source`` onto the target's column order.

    * a column named in ``constants`` becomes that literal (it need not exist in
      the source), cast to the target type;
    * any other column comes from the source and is cast (NULL when the value
      does not fit) when its type differs from the target's;
    * ``date_column`` is cut to its first ``date_length`` characters.
    """
    constants = dict(constants or {})
    src_types = {f.name: f.dataType for f in source.schema.fields}
    out = []
    for field in target_schema.fields:
        if field.name in constants:
            c = F.lit(constants[field.name]).cast(field.dataType)
        else:
            if field.name not in src_types:
                raise ValueError(f"column {field.name!r} is neither in the source nor a constant")
            c = F.col(field.name)
            if src_types[field.name] != field.dataType:
                c = c.try_cast(field.dataType)
        if date_column and field.name == date_column:
            c = date_text(c, date_length).cast(field.dataType)
        out.append(c.alias(field.name))
    return source.select(*out)


# P2 ----------------------------------------------------------------------------
def conform_columns(df: DataFrame, schema: StructType, strict: bool = False,
                    source_names: list[str] | None = None) -> list[Column]:
    """Expressions giving ``schema``'s columns in order from ``df``.

    Missing columns become typed NULLs and differing types are cast (NULL when a
    value does not fit).  ``source_names`` binds by position instead of by name.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    if source_names is not None:
        if len(source_names) != len(schema.fields):
            raise ValueError(f"expected {len(schema.fields)} columns, got {len(source_names)}")
        pairs = list(zip(source_names, schema.fields))
    else:
        if strict:
            unknown = [n for n in have if n not in schema.fieldNames()]
            if unknown:
                raise ValueError(f"columns not in the target schema: {unknown}")
        pairs = [(f.name if f.name in have else None, f) for f in schema.fields]
    out = []
    for src, field in pairs:
        if src is None:
            c = F.lit(None).cast(field.dataType)
        elif have[src] != field.dataType:
            c = F.col(src).try_cast(field.dataType)
        else:
            c = F.col(src)
        out.append(c.alias(field.name))
    return out


def conform_schema(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Select ``schema``'s columns in order; missing ones become typed NULLs.

    Unknown input columns are dropped, or rejected when ``strict``.
    """
    return df.select(*conform_columns(df, schema, strict))


def rename_by_position(df: DataFrame, schema: StructType) -> DataFrame:
    """Bind columns by position (``insertInto`` style), then conform types."""
    return df.select(*conform_columns(df, schema, source_names=df.columns))


# P4 ----------------------------------------------------------------------------
def filter_condition(df: DataFrame, condition: str | Column | None = None) -> DataFrame:
    """Rows satisfying a SQL predicate text (no condition = all rows)."""
    if condition is None or (isinstance(condition, str) and not condition.strip()):
        return df
    return df.filter(F.expr(condition) if isinstance(condition, str) else condition)


# P5 ----------------------------------------------------------------------------
def spec_predicate(spec: Mapping[str, object]) -> Column | None:
    """AND of ``col = value`` for a partition spec; NULL values match NULL."""
    parts = [F.col(k).isNull() if v is None else (F.col(k) == F.lit(v)) for k, v in spec.items()]
    return reduce(lambda a, b: a & b, parts) if parts else None


def partition_filter(df: DataFrame, spec: Mapping[str, object] | None) -> DataFrame:
    """Rows of one partition; an empty spec keeps the whole table."""
    pred = spec_predicate(spec or {})
    return df if pred is None else df.filter(pred)


# P6 ----------------------------------------------------------------------------
def range_predicate(value: Column | str, lower: str | None = None,
                    upper: str | None = None) -> Column:
    """Inclusive string range ``lower <= v <= upper``; empty bounds are open.

    Comparison is on text (so ``'2020-01-01' <= '2020-01-01 10:00:00'``), and a
    NULL value never matches.
    """
    v = _col(value).cast("string")
    pred = v.isNotNull()
    if lower:
        pred = pred & (v >= F.lit(lower))
    if upper:
        pred = pred & (v <= F.lit(upper))
    return pred


def range_filter(df: DataFrame, column: str, lower: str | None = None,
                 upper: str | None = None) -> DataFrame:
    return df.filter(range_predicate(column, lower, upper))


# P7 ----------------------------------------------------------------------------
def visible_path_predicate(path: Column | str, root: Column | str,
                           pattern: str = ".*") -> Column:
    """Path under ``root`` with no component starting ``_`` or ``.`` below the
    root, and fully matching ``pattern``."""
    p = _col(path)
    r = F.regexp_replace(root if isinstance(root, Column) else F.lit(root), "/$", "")
    below = p.substr(F.length(r) + 1, F.greatest(F.length(p), F.lit(1)))
    return (~below.rlike("/[_.]")) & p.rlike("^(?:" + pattern + ")$")


def visible_paths(df: DataFrame, path_column: str, root: Column | str,
                  pattern: str = ".*") -> DataFrame:
    return df.filter(visible_path_predicate(path_column, root, pattern))
