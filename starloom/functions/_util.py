from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Column name or Column -> Column (literals must be wrapped by the caller)."""
    return c if isinstance(c, Column) else F.col(c)


def as_col_or_lit(c) -> Column:
    """Strings are column names; numbers become literals."""
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)
