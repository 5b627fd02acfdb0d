"""Pivot, unpivot and superset union."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import UNION_SOURCE_COLUMN
from ..functions.text import slugify

_AGGS = {
    "sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg,
}
_CMPS = {
    "=": lambda a, b: a == b, "!=": lambda a, b: a != b, "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def pivot_columns(column: str | Column, values: Sequence, agg: str = "sum", cmp: str = "=",
                  prefix: str = "", suffix: str = "", then_value=1, else_value=0,
                  quote_identifiers: bool = True, distinct: bool = False,
                  alias: bool = True) -> list[Column]:
    """One aggregated CASE per value (A5), for use in ``groupBy(...).agg(*cols)``.

    Unlike ``groupBy().pivot()``, a group with no match gets ``else_value``
    aggregated (0 for sum), not NULL; ``agg='count'`` counts the else values
    too unless ``else_value`` is None. Output names are ``prefix+value+suffix``
    (slugified when ``quote_identifiers`` is False).
    """
    col = F.col(column) if isinstance(column, str) else column
    agg_fn = _AGGS[agg.lower()]
    test = _CMPS[cmp]
    out = []
    for v in values:
        then = then_value if isinstance(then_value, Column) else F.lit(then_value)
        other = else_value if isinstance(else_value, Column) else F.lit(else_value)
        expr = F.when(test(col, F.lit(v)), then).otherwise(other)
        if distinct:
            if agg.lower() == "count":
                agg_col = F.count_distinct(expr)
            elif agg.lower() == "sum":
                agg_col = F.sum_distinct(expr)
            elif agg.lower() == "avg":
                agg_col = F.sum_distinct(expr) / F.nullif(F.count_distinct(expr), F.lit(0))
            else:  # min/max ignore duplicates anyway
                agg_col = agg_fn(expr)
        else:
            agg_col = agg_fn(expr)
        if alias:
            name = f"{prefix}{v}{suffix}"
            agg_col = agg_col.alias(name if quote_identifiers else slugify(name))
        out.append(agg_col)
    return out


def pivot(df: DataFrame, group_cols: Sequence[str], column: str, values: Sequence | None = None,
          max_values: int | None = None, **kwargs) -> DataFrame:
    """``groupBy(group_cols).agg(pivot_columns(...))``: one shuffle, with
    map-side partial aggregation of every CASE column.

    Without ``values`` the distinct values of ``column`` are read first
    (most frequent first; the ``max_values`` most frequent if given): each
    becomes a column."""
    if values is None:
        from .aggregates import column_values_list
        values = column_values_list(df, column, max_records=max_values)
    return df.groupBy(*group_cols).agg(*pivot_columns(column, values, **kwargs))


def unpivot(df: DataFrame, cast_to: str = "string", exclude: Iterable[str] = (),
            remove: Iterable[str] = (), field_name: str = "field_name",
            value_name: str = "value") -> DataFrame:
    """Columns -> (name, value) rows (R1), in one scan (Expand), NULLs kept.

    Every unpivoted column is cast to ``cast_to`` first (booleans through
    text, so ``true``/``false``), which also makes mixed-type input legal.
    """
    exclude = list(exclude)
    low_ex = {c.lower() for c in exclude}
    low_rm = {c.lower() for c in remove}
    types = {f.name: f.dataType for f in df.schema.fields}
    value_cols = [c for c in df.columns if c.lower() not in low_ex and c.lower() not in low_rm]
    if not value_cols:
        raise ValueError("unpivot: no columns left to unpivot")
    casted = []
    for c in value_cols:
        ref = F.col(f"`{c}`")
        if isinstance(types[c], T.BooleanType):
            ref = ref.cast("string")
        casted.append(ref.cast(cast_to).alias(c))
    ids = [F.col(f"`{c}`") for c in exclude]
    staged = df.select(*ids, *casted)
    return staged.unpivot(exclude, value_cols, field_name, value_name)


def union_relations(relations: Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]],
                    column_override: Mapping[str, str] | None = None,
                    include: Iterable[str] = (), exclude: Iterable[str] = (),
                    source_column_name: str | None = UNION_SOURCE_COLUMN,
                    where: str | Column | None = None) -> DataFrame:
    """UNION ALL over the superset of columns.

    Columns appear in first-seen order; a column missing from an input is a
    NULL of the column's type; the type is the first one seen (or the
    override), and every input is cast to it *before* the union so Spark's own
    type widening never applies. ``where`` filters each input (pushed into
    each scan). Inputs are named; the name fills ``source_column_name``.
    """
    include = [c.lower() for c in include]
    exclude = [c.lower() for c in exclude]
    if include and exclude:
        raise ValueError("union_relations: give include or exclude, not both")
    items = list(relations.items()) if isinstance(relations, Mapping) else list(relations)
    # a bare table name is read from the session catalog
    items = [(it, None) if isinstance(it, str) else it for it in items]
    items = [(name, df if df is not None else _table(name)) for name, df in items]
    if not items:
        raise ValueError("union_relations needs at least one relation")
    override = dict(column_override or {})

    # names are compared without case; the first spelling seen is kept
    superset: dict[str, T.DataType] = {}
    spelled: dict[str, str] = {}
    per_rel: list[dict[str, str]] = []
    override = {k.lower(): v for k, v in override.items()}
    for _, df in items:
        mine = {}
        for f in df.schema.fields:
            low = f.name.lower()
            if exclude and low in exclude:
                continue
            if include and low not in include:
                continue
            mine[low] = f.name
            spelled.setdefault(low, f.name)
            superset.setdefault(low, f.dataType)
        per_rel.append(mine)
    if (include or exclude) and not superset:
        raise ValueError("union_relations: the column lists leave nothing of " + ", ".join(n for n, _ in items))

    parts = []
    for (name, df), mine in zip(items, per_rel):
        if where is not None:
            df = df.filter(where)
        cols = []
        if source_column_name is not None:
            cols.append(F.lit(name).cast("string").alias(source_column_name))
        for c, dt in superset.items():
            target = override.get(c, dt)
            src = F.col(f"`{mine[c]}`") if c in mine else F.lit(None)
            cols.append(src.cast(target).alias(spelled[c]))
        parts.append(df.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _table(name: str) -> DataFrame:
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession().table(name)


def unpivot_groups(df: DataFrame, ids: Sequence[str], groups: Mapping[str, Mapping[str, str]],
                   field_name: str = "field_name", cast_to: str | None = None) -> DataFrame:
    """Unpivot several value columns at once: ``groups`` maps each output
    label to {value_name: source column}. One scan, one Generate (explode of
    an array of structs); NULL values are kept, as in ``unpivot``."""
    names = None
    structs = []
    for label, cols in groups.items():
        if names is None:
            names = list(cols)
        elif list(cols) != names:
            raise ValueError("unpivot_groups: every group needs the same value names")
        fields = [F.lit(label).alias(field_name)]
        for vname, src in cols.items():
            c = F.col(f"`{src}`")
            fields.append((c.cast(cast_to) if cast_to else c).alias(vname))
        structs.append(F.struct(*fields))
    exploded = df.select(*[F.col(f"`{c}`") for c in ids], F.explode(F.array(*structs)).alias("__u"))
    return exploded.select(*[F.col(f"`{c}`") for c in ids], F.col(f"__u.{field_name}").alias(field_name),
                           *[F.col(f"__u.{v}").alias(v) for v in names])
