"""Aggregation helpers."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_match(cond: Column) -> Column:
    """``MAX(CASE WHEN cond THEN 1 ELSE 0 END)``: 1 when any row matches (A1)."""
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def distinct_members(df: DataFrame, cols: list[str]) -> DataFrame:
    """``SELECT DISTINCT cols`` (A2): a hash aggregate with map-side combine."""
    return df.select(*[F.col(f"`{c}`") for c in cols]).distinct()


def column_values(df: DataFrame, column: str, order_by: Column | None = None,
                  max_records: int | None = None, where: str | Column | None = None,
                  descending: bool = True, default: Sequence | None = None) -> DataFrame:
    """Distinct values of ``column`` ordered by an aggregate.

    Default order: frequency, most frequent first, ties by value. With
    ``max_records`` the plan is a TakeOrderedAndProject (top-k per partition,
    then a k-row merge), never a full sort. ``default`` lists the values to
    return (with a NULL ordering) when the input has no rows.
    """
    src = df if where is None else df.filter(where)
    measure = F.count(F.lit(1)) if order_by is None else order_by
    grouped = src.groupBy(F.col(f"`{column}`")).agg(measure.alias("__ord"))
    ord_col = F.col("__ord").desc_nulls_last() if descending else F.col("__ord").asc_nulls_last()
    out = grouped.orderBy(ord_col, F.col(f"`{column}`").asc_nulls_last())
    if max_records is not None:
        out = out.limit(max_records)
    out = out.select(F.col(f"`{column}`"), F.col("__ord").alias("ordering"))
    if default is None:
        return out
    kinds = {f.name: f.dataType for f in out.schema.fields}
    none = src.limit(1).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
    return out.unionByName(none.select(F.explode(F.array(*[F.lit(v).cast(kinds[column]) for v in default])).alias(column),
                                       F.lit(None).cast(kinds["ordering"]).alias("ordering")))


#: Values that name columns at most; more are an error, not a plan of that width.
MAX_NAMES = 1000


def column_values_list(df: DataFrame, column: str, max_records: int | None = None,
                       where: str | Column | None = None, default=None, max_names: int = MAX_NAMES) -> list:
    """Values as a Python list, only to *name* columns (e.g. pivot output):
    all of them, or the ``max_records`` most frequent. More than ``max_names``
    values are an error; no more than that reach the driver."""
    asked = max_names + 1 if max_records is None else max_records
    rows = column_values(df, column, max_records=min(asked, max_names + 1), where=where).collect()
    if len(rows) > max_names:
        raise ValueError(f"{column} has more than {max_names} values: give max_records or max_names, or aggregate without naming columns")
    vals = [r[0] for r in rows]
    return vals if vals else (list(default) if default is not None else [])


#: Values that a frequency sketch tracks, and candidates that are counted again.
TRACKED, CANDIDATES = 65_536, 1000


def top_values(df: DataFrame, column: str, k: int, where: str | Column | None = None,
               tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """``column_values`` with ``max_records=k`` for a column of very many values: the
    same rows, without a shuffle of all values where a sketch proves them.

    Mergeable frequency sketches give candidates; these are counted exactly. A value
    that is no candidate occurs at most as often as the last candidate is estimated
    to, or, untracked, as the sketch's error. If the k-th candidate's exact
    count is above both, the candidates' order is the answer; otherwise (a flat
    column, ties at the boundary) the values are counted in full. Both are in the
    plan; the one that does not apply gets no rows.
    """
    src = (df if where is None else df.filter(where)).select(F.col(f"`{column}`").alias(column))
    c = F.col(f"`{column}`")
    candidates = min(max(candidates, 2 * k), tracked)
    sketch = src.where(c.isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{column}`, {candidates}, {tracked})").alias("top"))
    # an estimate is never below the count; of a sketch for m values, in slots of
    # 2^j >= m / 0.75, untracked values are below 3.5 / 2^j of all, values it does not return below twice that
    slots = 1 << (-(-tracked * 4 // 3) - 1).bit_length()
    unseen = sketch.select(F.greatest(
        F.when(F.size("top") == candidates, F.element_at("top", -1)["count"]).otherwise(0), F.ceil(F.col("n") * 7 / slots) - 1).alias("b"))
    names = sketch.select(F.explode(F.array_append(F.col("top")["item"], F.lit(None))).alias("item"))
    counted = (src.join(names, c.eqNullSafe(F.col("item")), "left_semi").groupBy(c).agg(F.count(F.lit(1)).alias("ordering")))
    best = counted.orderBy(F.desc("ordering"), c.asc_nulls_last()).limit(k)
    proven = F.coalesce(best.agg(F.when(F.count(F.lit(1)) == k, F.min("ordering"))).scalar() > unseen.scalar(), F.lit(False))
    every = column_values(src.where(~proven), column, max_records=k)
    return best.where(proven).unionByName(every).select(c, "ordering")
