"""Surrogate keys (F1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import SURROGATE_KEY_NULL as NULL_TOKEN
from ..fixed_values import SURROGATE_KEY_SEPARATOR as SEPARATOR
from ._util import as_col

_HASHABLE = (T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType,
             T.BooleanType, T.DateType, T.DecimalType)


def _text(c: Column) -> Column:
    """``c`` as text. Floating values have no text form that engines share: the
    job fails on them (the type test is folded away when the plan is made)."""
    floating = F.typeof(c).isin("float", "double")
    return F.when(floating, F.raise_error(F.concat(F.lit("surrogate_key: cast to decimal or string first, not "), F.typeof(c)))
                  ).otherwise(c.cast("string"))


def surrogate_key(*cols, nulls_as_empty: bool = False) -> Column:
    """md5 of the fields cast to text and joined by ``-``; NULL becomes a
    fixed token (or ``''`` when ``nulls_as_empty``).

    JVM-side ``md5(concat_ws(...))``: stays inside whole-stage codegen.
    Booleans are rendered lowercase (``true``/``false``) as PostgreSQL does.
    """
    if len(cols) == 1 and isinstance(cols[0], (list, tuple)):
        cols = tuple(cols[0])
    if not cols:
        raise ValueError("surrogate_key needs at least one field")
    token = F.lit("" if nulls_as_empty else NULL_TOKEN)
    parts = [F.coalesce(_text(as_col(c)), token) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def check_hashable(df: DataFrame, cols: list[str]) -> None:
    """Refuse floating columns: their text form differs between engines."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    for c in cols:
        dt = fields.get(c)
        if dt is not None and not isinstance(dt, _HASHABLE):
            raise TypeError(f"column {c!r} of type {dt.simpleString()} has no stable "
                            "text form for hashing; cast it to decimal or string first")
