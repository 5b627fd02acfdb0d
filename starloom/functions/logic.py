"""Conditional column logic: tiering, LIKE classification, guarded casts,
row-wise arg-max, two-sided outcomes, threshold counts (P6-P11, F11, F17-F19).

Everything compiles to CASE WHEN / built-in expressions (JVM codegen).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col, as_col_or_lit


def tier(value, thresholds: Sequence[tuple[float, str]], default: str,
         op: str = ">=", guards: Sequence[tuple[Column, str]] = ()) -> Column:
    """Ordered threshold tiering (P6): first matching rule wins.

    ``guards`` are (condition, label) rules checked before the thresholds
    (e.g. "too few minutes"); ``op`` is the comparison of value to threshold.
    """
    v = as_col_or_lit(value)
    cmp = {">=": lambda t: v >= t, ">": lambda t: v > t,
           "<=": lambda t: v <= t, "<": lambda t: v < t}[op]
    rules = list(guards) + [(cmp(F.lit(t)), label) for t, label in thresholds]
    return case(rules, default)


def case(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """``CASE WHEN c1 THEN v1 ... ELSE default END`` from a rule list."""
    if not rules:
        return F.lit(default)
    expr = None
    for cond, val in rules:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def like_any(c, patterns: Sequence[str]) -> Column:
    """``c LIKE ANY (patterns)`` as an OR of LIKEs (portable, pushes down)."""
    col = as_col(c)
    return reduce(lambda a, b: a | b, [col.like(p) for p in patterns])


def like_classify(c, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """Ordered LIKE classification (P9); NULL input falls to ``default``."""
    return case([(like_any(c, pats), label) for pats, label in rules], default)


def regex_guarded_cast(c, pattern: str = r"^[0-9.]+$", to: str = "double",
                       default=0) -> Column:
    """Cast only text that matches ``pattern``; else ``default`` (P10).

    Text such as ``'1.2.3'``, which matches the pattern but is no number, gives
    the default too.
    """
    col = as_col(c)
    return F.coalesce(F.when(col.rlike(pattern), col.try_cast(to)), F.lit(default).cast(to))


def clock_to_minutes(c, guarded: bool = False) -> Column:
    """``'MM:SS'`` -> MM + SS/60; plain number kept; NULL or ``''`` -> 0.

    Computed in double. With ``guarded`` a plain value must look numeric,
    otherwise it is 0 (the extended model's rule).
    """
    s = as_col(c)
    mins = F.split_part(s, F.lit(":"), F.lit(1)).cast("double")
    secs = F.split_part(s, F.lit(":"), F.lit(2)).cast("double")
    plain = regex_guarded_cast(s, default=0.0) if guarded else s.cast("double")
    present = s.isNotNull() & (s != F.lit(""))
    return (F.when(present & s.like("%:%"), mins + secs / F.lit(60.0))
            .when(present, plain)
            .otherwise(F.lit(0.0)))


def row_argmax(cols: Sequence, labels: Sequence[str]) -> Column:
    """Label of the largest column; ties go to the earliest column."""
    vals = [as_col_or_lit(c) for c in cols]
    top = F.greatest(*vals)
    return case([(top == v, lab) for v, lab in zip(vals[:-1], labels[:-1])], labels[-1])


def two_side_outcome(a_score, b_score, a_value, b_value):
    """Winner, loser and side from two scores; a tie gives NULL.

    Returns a dict of Columns: winner, loser, side, abs_diff, total.
    """
    a, b = as_col(a_score), as_col(b_score)
    av, bv = as_col_or_lit(a_value), as_col_or_lit(b_value)
    return {
        "winner": F.when(a > b, av).when(b > a, bv),
        "loser": F.when(a < b, av).when(b < a, bv),
        "side": F.when(a > b, F.lit("HOME")).when(b > a, F.lit("AWAY")),
        "abs_diff": F.abs(a - b),
        "total": a + b,
    }


def threshold_count(cols: Sequence, threshold) -> Column:
    """Number of columns (NULL as 0) at or above ``threshold``."""
    t = F.lit(threshold)
    return reduce(lambda x, y: x + y,
                  [F.when(F.coalesce(as_col_or_lit(c), F.lit(0)) >= t, 1).otherwise(0)
                   for c in cols])


def thresholds_from_data(df, column: str, quantiles) -> list:
    """Data-driven thresholds for ``tier`` (the optional form of P7), as values: the
    exact quantiles of ``column``, computed at once. ``quantile_columns`` gives the
    same as columns, without a job."""
    from ..operators.quantiles import exact_quantiles
    found = exact_quantiles(df, column, quantiles).first()[0]
    return [v for v in found if v is not None]


def quartile_label(value, cuts, labels=("Q1", "Q2", "Q3", "Q4")) -> Column:
    """``Q1`` below the first cut, ``Q2`` below the second, ... (strict ``<``),
    the last label otherwise: the quartile labels of the extended model."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("quartile_label needs one more label than cuts")
    return tier(value, list(zip(cuts, labels[:-1])), labels[-1], op="<")
