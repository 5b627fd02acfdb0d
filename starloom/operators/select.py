"""Column-list operators."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def filtered_columns(df: DataFrame, except_: Iterable[str] = ()) -> list[str]:
    """Column names minus ``except_`` (case-insensitive), in table order.

    Reads the schema only; no job runs.
    """
    drop = {c.lower() for c in except_}
    return [c for c in df.columns if c.lower() not in drop]


def star(df: DataFrame, except_: Iterable[str] = (), relation_alias: str | None = None,
         prefix: str = "", suffix: str = "") -> list[Column]:
    """The ``star`` column list (P1): every column but ``except_``.

    Columns are renamed only when a prefix or suffix is set, so the list can
    also serve as a ``groupBy`` list. With ``relation_alias`` the columns are
    qualified (``alias.col``) for use after ``df.alias(...)`` joins.
    """
    cols = []
    for c in filtered_columns(df, except_):
        ref = F.col(f"{relation_alias}.`{c}`") if relation_alias else F.col(f"`{c}`")
        cols.append(ref.alias(f"{prefix}{c}{suffix}") if (prefix or suffix) else ref)
    return cols


def nullcheck_columns(df: DataFrame, cols: Iterable[str] | None = None) -> list[Column]:
    """``nullif(c, '')`` on string columns, others unchanged."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in (cols if cols is not None else df.columns):
        ref = F.col(f"`{c}`")
        out.append(F.nullif(ref, F.lit("")).alias(c) if isinstance(types[c], T.StringType) else ref)
    return out


def nullcheck_table(df: DataFrame) -> DataFrame:
    """P3 over a whole table (P4): one projection, no shuffle."""
    return df.select(*nullcheck_columns(df))


def group_by_n(df: DataFrame, n: int, *aggs: Column) -> DataFrame:
    """Group by the first ``n`` columns of ``df`` (A4); partial aggregation
    happens map-side before the shuffle."""
    if n < 1 or n > len(df.columns):
        raise ValueError(f"group_by_n: n={n} outside 1..{len(df.columns)}")
    return df.groupBy(*df.columns[:n]).agg(*aggs)
