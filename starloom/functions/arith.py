"""Null-safe arithmetic (F2-F4, F20, F21), equal-width buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col_or_lit


def safe_add(*fields) -> Column:
    """Sum with NULL treated as 0."""
    if len(fields) == 1 and isinstance(fields[0], (list, tuple)):
        fields = tuple(fields[0])
    if not fields:
        raise ValueError("safe_add needs a non-empty list of fields")
    return reduce(lambda a, b: a + b, [F.coalesce(as_col_or_lit(f), F.lit(0)) for f in fields])


def safe_subtract(fields) -> Column:
    """Left-to-right difference with NULL treated as 0; a list is required."""
    if not isinstance(fields, (list, tuple)) or not fields:
        raise TypeError("safe_subtract takes a non-empty list of fields")
    return reduce(lambda a, b: a - b, [F.coalesce(as_col_or_lit(f), F.lit(0)) for f in fields])


def safe_divide(numerator, denominator) -> Column:
    """NULL when the denominator is 0 (or NULL); never raises under ANSI."""
    return as_col_or_lit(numerator) / F.nullif(as_col_or_lit(denominator), F.lit(0))


def ratio_or_zero(numerator, denominator, guard=None) -> Column:
    """``CASE WHEN guard > 0 THEN n / d ELSE 0 END`` as double.

    ``guard`` defaults to the denominator. Division is done in double so the
    result does not depend on decimal scale rules (V2).
    """
    n = as_col_or_lit(numerator).cast("double")
    d = as_col_or_lit(denominator).cast("double")
    g = d if guard is None else as_col_or_lit(guard)
    return F.when(g > 0, n / d).otherwise(F.lit(0.0))


def coalesce_zero(c, default=0) -> Column:
    return F.coalesce(as_col_or_lit(c), F.lit(default))


def deltas(cols: list) -> list[Column]:
    """Consecutive differences ``c[i] - c[i-1]`` with NULL as 0."""
    z = [coalesce_zero(c) for c in cols]
    return [z[i] - z[i - 1] for i in range(1, len(z))]


def width_bucket(expr, min_value, max_value, num_buckets) -> Column:
    """Equal-width bucket by the formula (F6):
    ``ceil((x - min) / bin)`` capped at ``n + 1``, plus 1 when ``x mod bin = 0``.

    The edge test uses ``x`` itself (not ``x - min``), and values below the
    minimum are not clamped -- both as in the formula this reproduces. It is
    computed in decimals, as fractional bins have no exact double: with
    ``w = max - min``, ``x mod bin = 0`` is ``x * n mod w = 0`` and the ceiling
    is the whole part of ``(x - min) * n / w``, plus 1 if there is a rest.
    Values too large for 16 digits before the point fall back to doubles.
    """
    n = as_col_or_lit(num_buckets)
    many = n.cast("decimal(9,0)")
    x, lo, hi = (as_col_or_lit(v).try_cast("decimal(28,12)") for v in (expr, min_value, max_value))
    width = hi - lo
    above = (x - lo).cast("decimal(28,12)") * many
    edge = F.when((x * many) % width == 0, F.lit(1)).otherwise(F.lit(0))
    whole = F.call_function("div", above, width)
    exact = edge + F.least(whole + F.when(above % width > 0, 1).otherwise(0), (n + 1).cast("long"))
    dx, dlo, dhi = (as_col_or_lit(v).cast("double") for v in (expr, min_value, max_value))
    size = (dhi - dlo) / n.cast("double")
    rough = F.when(dx % size == 0, F.lit(1)).otherwise(F.lit(0)) + F.least(F.ceil((dx - dlo) / size), (n + 1).cast("long"))
    return F.when(above.isNotNull() & width.isNotNull(), exact).otherwise(rough)
