"""Data-quality checks: each returns the failing rows as a DataFrame (Q1-Q19).

A check is "a query whose rows are the failures". Every check function
returns a :class:`Check` holding that DataFrame and its failure-count
expression (``fail_calc``; default ``count(*)``). ``run_suite`` turns a list
of checks into one summary DataFrame (one aggregate per check), so counting
is distributed and only the summary rows reach the driver.

Checks that order whole tables (sequential values, exclusive ranges)
collapse duplicate rows into counts and use the range-parallel neighbour
operator, so no single task receives a whole table or a whole hot group.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as N
from ..fixed_values import EQUAL_ROWCOUNT_ID, FEWER_ROWS_THAN_ID
from ..functions.text import slugify
from .ordered import neighbour, replicate


@dataclass
class Check:
    name: str
    failures: DataFrame
    fail_calc: Column | None = None  # None = count(*)
    severity: str = "warn"
    # conditions on the number of failures; None: the suite's
    warn_if: str | None = None
    error_if: str | None = None
    # a check of single rows: its relation and the condition a failing row meets
    relation: DataFrame | None = None
    fails: Column | None = None

    def count_expr(self) -> Column:
        return F.count(F.lit(1)) if self.fail_calc is None else self.fail_calc


def _scope(df: DataFrame, where: str | Column | None) -> DataFrame:
    return df if where is None else df.filter(where)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _row_check(name: str, df: DataFrame, fails: Column, where, failures: DataFrame | None = None) -> Check:
    """A check that looks at one row at a time."""
    if where is not None:
        fails = (F.expr(where) if isinstance(where, str) else where) & fails
    return Check(name, df.filter(fails) if failures is None else failures, relation=df, fails=fails)


# ------------------------------------------------------------------ Q1
def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None,
                   inclusive: bool = True, where=None) -> Check:
    c = _c(column)
    cond = F.lit(False)
    if min_value is not None:
        cond = cond | ~((c >= F.lit(min_value)) if inclusive else (c > F.lit(min_value)))
    if max_value is not None:
        cond = cond | ~((c <= F.lit(max_value)) if inclusive else (c < F.lit(max_value)))
    return _row_check("accepted_range", df, cond, where)


# ------------------------------------------------------------------ Q2
def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = (), where=None) -> Check:
    """No non-NULL value (per group). Ungrouped, one non-NULL row is enough:
    the filter + limit lets Spark stop at the first match."""
    src = _scope(df, where)
    if not group_by:
        pruned = src.select(_c(column)).filter(_c(column).isNotNull()).limit(1)
        out = pruned.agg(F.count(_c(column)).alias(N.FILLER)).filter(F.col(N.FILLER) == 0)
    else:
        out = (src.groupBy(*[_c(g) for g in group_by]).agg(F.count(_c(column)).alias(N.FILLER))
               .filter(F.col(N.FILLER) == 0))
    return Check("at_least_one", out)


# ------------------------------------------------------------------ Q3
def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str, where=None) -> Check:
    """(value, count) pairs present on one side only; one tagged union and
    one aggregation instead of two EXCEPTs (four scans)."""
    a = _scope(df, where).groupBy(_c(column).alias(column)).agg(F.count(F.lit(1)).alias(N.NUM_ROWS))
    b = to.groupBy(_c(field).alias(column)).agg(F.count(F.lit(1)).alias(N.NUM_ROWS))
    return Check("cardinality_equality", _one_sided(a, b, [column, N.NUM_ROWS]))


def _one_sided(a: DataFrame, b: DataFrame, cols: list[str], tag: str | None = None) -> DataFrame:
    """Set difference both ways (NULLs equal, duplicates ignored) in one pass."""
    tagged = (a.select(*[_c(c) for c in cols]).withColumn("__a", F.lit(1)).withColumn("__b", F.lit(0))
              .unionByName(b.select(*[_c(c) for c in cols]).withColumn("__a", F.lit(0))
                           .withColumn("__b", F.lit(1))))
    g = tagged.groupBy(*[_c(c) for c in cols]).agg(F.max("__a").alias("__in_a"),
                                                    F.max("__b").alias("__in_b"))
    one = g.filter(F.col("__in_a") != F.col("__in_b"))
    if tag is None:
        return one.select(*[_c(c) for c in cols])
    which = F.when(F.col("__in_a") == 1, F.lit(N.A_MINUS_B)).otherwise(F.lit(N.B_MINUS_A))
    return one.select(which.alias(tag), *[_c(c) for c in cols])


# ------------------------------------------------------------------ Q4, Q15
def _counts_full_join(df, compare, group_by, id_name, a_name, b_name, where):
    gb = list(group_by)
    a = (_scope(df, where).groupBy(*[_c(g) for g in gb]).agg(F.count(F.lit(1)).alias(a_name))
         .withColumn(id_name, F.lit(1)))
    b = (compare.groupBy(*[_c(g) for g in gb]).agg(F.count(F.lit(1)).alias(b_name))
         .withColumn(id_name, F.lit(1)))
    aa = a.select(*[_c(c).alias(f"{c}_a") for c in [id_name, *gb]], a_name)
    bb = b.select(*[_c(c).alias(f"{c}_b") for c in [id_name, *gb]], b_name)
    cond = None
    for c in [id_name, *gb]:
        e = F.col(f"`{c}_a`") == F.col(f"`{c}_b`")
        cond = e if cond is None else cond & e
    j = aa.join(bb, cond, "full")
    pairs = []
    for c in [id_name, *gb]:
        pairs += [F.col(f"`{c}_a`"), F.col(f"`{c}_b`")]
    return j.select(*pairs, a_name, b_name)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (),
                   where=None) -> Check:
    """Row counts per group; failures = sum of |a - b| (a one-sided group
    gives NULL, counted as 0)."""
    j = _counts_full_join(df, compare, group_by, EQUAL_ROWCOUNT_ID,
                          N.COUNT_A, N.COUNT_B, where)
    out = j.withColumn(N.DIFF_COUNT, F.abs(F.col(N.COUNT_A) - F.col(N.COUNT_B)))
    return Check("equal_rowcount", out, F.sum(F.coalesce(F.col(N.DIFF_COUNT), F.lit(0))))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (),
                    where=None) -> Check:
    j = _counts_full_join(df, compare, group_by, FEWER_ROWS_THAN_ID,
                          N.COUNT_OURS, N.COUNT_COMPARED, where)
    a, b = F.col(N.COUNT_OURS), F.col(N.COUNT_COMPARED)
    out = j.withColumn(N.ROW_COUNT_DELTA,
                       F.when(a > b, a - b).when(a == b, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))
    return Check("fewer_rows_than", out, F.sum(F.coalesce(F.col(N.ROW_COUNT_DELTA), F.lit(0))))


# ------------------------------------------------------------------ Q5
def _rounded(c: Column, kind: T.DataType, precision: int) -> Column:
    """``c`` rounded to ``precision`` decimals in its own type: decimals keep
    their scale, floating values are rounded as doubles (no fixed width)."""
    if isinstance(kind, T.DecimalType):
        return F.round(c, precision) if precision < kind.scale else c
    return F.round(c.cast("double"), precision)


def _differing(a: DataFrame, b: DataFrame, cols: list[str], buckets: int) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in the hash buckets whose digests differ. A digest (row
    count, sum and xor of two row hashes) does not depend on the order of rows; equal
    digests mean equal multisets of rows. Buckets that differ only in repeats are
    compared too, as sets."""
    bucket = F.pmod(F.xxhash64(*[_c(c) for c in cols]), F.lit(buckets)).cast("int")
    other = F.xxhash64(F.lit("second"), *[_c(c) for c in reversed(cols)])

    def digest(x: DataFrame, side: str) -> DataFrame:
        return x.groupBy(bucket.alias("__bucket")).agg(F.struct(
            F.count(F.lit(1)).alias("n"), F.sum(other.cast("decimal(38,0)")).alias("s"),
            F.bit_xor(F.xxhash64(*[_c(c) for c in cols])).alias("x")).alias(side))

    unequal = (digest(a, "__a").join(digest(b, "__b"), "__bucket", "full").where(~F.col("__a").eqNullSafe(F.col("__b"))).select("__bucket"))
    return tuple(x.withColumn("__bucket", bucket).join(unequal, "__bucket", "left_semi").drop("__bucket") for x in (a, b))


def equality(df: DataFrame, compare: DataFrame, compare_columns: Sequence[str] | None = None,
             exclude_columns: Sequence[str] | None = None, precision: int | None = None,
             where=None, digest_buckets: int | None = None) -> Check:
    """Rows in one table only (set semantics), tagged ``which_diff``.

    With ``digest_buckets`` the sides are first compared by digests of so many hash
    buckets, one small row a bucket and side; only rows of buckets whose digests
    differ are shuffled and compared. For tables that are (nearly) equal.

    With ``precision``, float and decimal columns (not integers) are rounded
    (as decimals) first.
    fail_calc = rows + |#a_minus_b - #b_minus_a|.
    """
    if compare_columns and exclude_columns:
        raise ValueError("equality: give compare_columns or exclude_columns, not both")
    a = _scope(df, where)
    if compare_columns:
        low = {c.lower() for c in compare_columns}
        cols = [c for c in a.columns if c.lower() in low]
    else:
        ex = {c.lower() for c in (exclude_columns or [])}
        cols = [c for c in a.columns if c.lower() not in ex]
        other = {c.lower() for c in compare.columns if c.lower() not in ex}
        if {c.lower() for c in cols} != other:
            raise ValueError("equality: the two tables have different columns")

    def prep(x: DataFrame) -> DataFrame:
        types = {f.name.lower(): f.dataType for f in x.schema.fields}
        out = []
        for c in cols:
            ref = F.col(f"`{c}`")
            if precision is not None and isinstance(types[c.lower()], T.FractionalType):
                ref = _rounded(ref, types[c.lower()], precision)
            out.append(ref.alias(c))
        return x.select(*out)

    sides = prep(a), prep(compare)
    if digest_buckets:
        sides = _differing(*sides, cols, digest_buckets)
    diff = _one_sided(*sides, cols, tag=N.WHICH_DIFF)
    n_a = F.sum(F.when(F.col(N.WHICH_DIFF) == N.A_MINUS_B, 1).otherwise(0))
    n_b = F.sum(F.when(F.col(N.WHICH_DIFF) == N.B_MINUS_A, 1).otherwise(0))
    calc = F.count(F.lit(1)) + F.coalesce(F.abs(n_a - n_b), F.lit(0))
    return Check("equality", diff, calc)


# ------------------------------------------------------------------ Q6
def expression_is_true(df: DataFrame, expression: str, column_name: str | None = None,
                       where=None) -> Check:
    expr = f"`{column_name}` {expression}" if column_name else expression
    return _row_check("expression_is_true", df, ~F.expr(expr), where)


# ------------------------------------------------------------------ Q7
_GAP_OPS = {"not_allowed": ("=", N.EQUAL_TO), "allowed": ("<=", N.LESS_OR_EQUAL), "required": ("<", N.LESS)}


def mutually_exclusive_ranges(df: DataFrame, lower_bound_column: str, upper_bound_column: str,
                              partition_by: str | Column | None = None, gaps: str = "allowed",
                              zero_length_range_allowed: bool = False, where=None,
                              rows_per_range: int | None = None) -> Check:
    """Ranges ordered by (lower, upper) must not overlap (gap rules as named).

    Equal (partition, lower, upper) rows are collapsed into counts: within a
    run of equal ranges the next lower bound is the range's own lower bound,
    and only the last row of the run looks at the next distinct range.
    """
    if gaps not in _GAP_OPS:
        raise ValueError(f"gaps must be one of {list(_GAP_OPS)}; got {gaps!r}")
    gap_op, gap_words = _GAP_OPS[gaps]
    zl_op, zl_words = ("<=", N.LESS_OR_EQUAL) if zero_length_range_allowed else ("<", N.LESS)
    src = _scope(df, where)
    part = ["partition_by_col"] if partition_by is not None else []
    if isinstance(partition_by, str):
        # a column name, or a SQL expression over the columns
        partition_by = _c(partition_by) if partition_by in src.columns else F.expr(partition_by)
    base_cols = ([partition_by.alias("partition_by_col")] if partition_by is not None else []) + [
        _c(lower_bound_column).alias("lower_bound"), _c(upper_bound_column).alias("upper_bound")]
    runs = src.select(*base_cols).groupBy(*part, "lower_bound", "upper_bound").agg(
        F.count(F.lit(1)).alias("__n"))
    nb = neighbour(runs, part, ["lower_bound", "upper_bound"], "lower_bound", "next",
                   "__next", rows_per_range)
    last_of_run = nb.select(*part, "lower_bound", "upper_bound",
                            F.col("__next").alias("next_lower_bound"),
                            (~F.col("__next_exists")).alias("is_last_record"))
    repeats = replicate(nb.select(*part, "lower_bound", "upper_bound", "__n"), F.col("__n") - 1)
    repeats = repeats.select(*part, "lower_bound", "upper_bound",
                             F.col("lower_bound").alias("next_lower_bound"),
                             F.lit(False).alias("is_last_record"))
    rows = last_of_run.unionByName(repeats)
    lo, up, nxt = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    cmp = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "=": lambda a, b: a == b}
    ok_len = F.coalesce(cmp[zl_op](lo, up), F.lit(False))
    ok_gap = F.coalesce(cmp[gap_op](up, nxt), F.col("is_last_record"), F.lit(False))
    calc = rows.select("*", ok_len.alias(f"lower_bound_{zl_words}_upper_bound"),
                       ok_gap.alias(f"upper_bound_{gap_words}_next_lower_bound"))
    fails = calc.filter(~(F.col(f"lower_bound_{zl_words}_upper_bound")
                          & F.col(f"upper_bound_{gap_words}_next_lower_bound")))
    return Check("mutually_exclusive_ranges", fails)


# ------------------------------------------------------------------ Q8
def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = (), where=None) -> Check:
    src = _scope(df, where)
    g = src.groupBy(*[_c(c) for c in group_by]) if group_by else src.groupBy()
    out = g.agg(F.count_distinct(_c(column)).alias(N.FILLER)).filter(F.col(N.FILLER) == 1)
    return Check("not_constant", out)


# ------------------------------------------------------------------ Q9
def not_accepted_values(df: DataFrame, column: str, values: Iterable, where=None) -> Check:
    vals = list(values)
    out = (_scope(df, where).select(_c(column).alias(N.VALUE_FIELD)).distinct()
           .filter(F.col(N.VALUE_FIELD).isin(vals)))
    return Check("not_accepted_values", out)


# ------------------------------------------------------------------ Q10
def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
                        group_by: Sequence[str] = (), where=None) -> Check:
    src = _scope(df, where)
    g = src.groupBy(*[_c(c) for c in group_by]) if group_by else src.groupBy()
    prop = (F.sum(F.when(_c(column).isNull(), 0).otherwise(1)).cast("double")
            / F.count(F.lit(1)).cast("double"))
    v = g.agg(prop.alias("not_null_proportion"))
    out = v.filter((F.col("not_null_proportion") < F.lit(at_least))
                   | (F.col("not_null_proportion") > F.lit(at_most)))
    return Check("not_null_proportion", out)


# ------------------------------------------------------------------ Q11
_DATEPARTS = {"second": "SECOND", "minute": "MINUTE", "hour": "HOUR", "day": "DAY",
              "week": "WEEK", "month": "MONTH", "quarter": "QUARTER", "year": "YEAR"}


def _date_add(c: Column, datepart: str, n: int) -> Column:
    unit = _DATEPARTS[datepart.lower()]
    return F.timestamp_add(unit, F.lit(n), c.cast("timestamp_ntz"))


def recency(df: DataFrame, field: str, datepart: str, interval: int,
            now: _dt.datetime | str | Column | None = None, ignore_time_component: bool = False,
            group_by: Sequence[str] = (), where=None) -> Check:
    """Newest ``field`` older than ``now - interval``. ``now`` is a parameter
    (default: the current timestamp) so that tests repeat."""
    src = _scope(df, where)
    if now is None:
        now_c = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(now, Column):
        now_c = now
    else:
        now_c = F.lit(str(now)).cast("timestamp_ntz")
    threshold = _date_add(now_c, datepart, -interval)
    if ignore_time_component:
        threshold = threshold.cast("date")
    g = src.groupBy(*[_c(c) for c in group_by]) if group_by else src.groupBy()
    most = F.max(_c(field))
    v = g.agg((most.cast("date") if ignore_time_component else most).alias(N.MOST_RECENT))
    out = v.select(*[_c(c) for c in group_by], N.MOST_RECENT, threshold.alias(N.THRESHOLD)) \
        .filter(F.col(N.MOST_RECENT) < F.col(N.THRESHOLD))
    return Check("recency", out)


# ------------------------------------------------------------------ Q12, Q17
def relationships_where(df: DataFrame, column: str, to: DataFrame, field: str,
                        from_condition: str = "1=1", to_condition: str = "1=1", where=None) -> Check:
    left = (_scope(df, where).filter(F.expr(from_condition)).filter(_c(column).isNotNull())
            .select(_c(column).alias("id")))
    right = to.filter(F.expr(to_condition)).filter(_c(field).isNotNull()).select(_c(field).alias("id"))
    out = left.join(right, "id", "left_anti").withColumn(N.RIGHT_ID, F.lit(None).cast(left.schema["id"].dataType))
    return Check("relationships_where", out)


def relationships(df: DataFrame, column: str, to: DataFrame, field: str, where=None) -> Check:
    child = _scope(df, where).filter(_c(column).isNotNull()).select(_c(column).alias(N.FROM_FIELD))
    parent = to.select(_c(field).alias(N.FROM_FIELD))
    return Check("relationships", child.join(parent, N.FROM_FIELD, "left_anti"))


def unique(df: DataFrame, column: str, where=None) -> Check:
    out = (_scope(df, where).filter(_c(column).isNotNull()).groupBy(_c(column).alias("unique_field"))
           .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))
    return Check("unique", out)


def not_null(df: DataFrame, column: str, where=None) -> Check:
    return _row_check("not_null", df, _c(column).isNull(), where)


def accepted_values(df: DataFrame, column: str, values: Iterable, where=None) -> Check:
    vals = list(values)
    out = (_scope(df, where).groupBy(_c(column).alias(N.VALUE_FIELD))
           .agg(F.count(F.lit(1)).alias("n_records"))
           .filter(~F.coalesce(F.col(N.VALUE_FIELD).isin(vals), F.lit(False))))
    return Check("accepted_values", out)


# ------------------------------------------------------------------ Q13
def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True, where=None) -> Check:
    v = F.trim(_c(column)) if trim_whitespace else _c(column)
    out = _scope(df, where).select(v.alias(column)).filter(_c(column) == F.lit(""))
    return _row_check("not_empty_string", df, v == F.lit(""), where, out)


# ------------------------------------------------------------------ Q14
def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
                      group_by: Sequence[str] = (), where=None,
                      rows_per_range: int | None = None) -> Check:
    """Value differs from the previous value (in value order) + interval.

    Runs on distinct values with counts: the first row of a run of equal
    values compares with the previous distinct value, the other rows of the
    run with the value itself. NULL values never fail and are skipped.
    """
    prev = "previous_" + slugify(column)
    gb = list(group_by)
    src = _scope(df, where).filter(_c(column).isNotNull())
    runs = src.groupBy(*[_c(g) for g in gb], _c(column)).agg(F.count(F.lit(1)).alias("__n"))
    nb = neighbour(runs, gb, [column], column, "prev", "__prev", rows_per_range)
    first_rows = nb.select(*[_c(g) for g in gb], _c(column), F.col("__prev").alias(prev))
    repeats = replicate(nb.select(*[_c(g) for g in gb], _c(column), "__n"), F.col("__n") - 1)
    repeats = repeats.select(*[_c(g) for g in gb], _c(column), _c(column).alias(prev))
    windowed = first_rows.unionByName(repeats)
    if datepart:
        ok = (_c(column).cast("timestamp_ntz")
              == _date_add(F.col(prev), datepart, interval).cast("timestamp_ntz"))
    else:
        ok = _c(column) == F.col(prev) + F.lit(interval)
    return Check("sequential_values", windowed.filter(~ok))


# ------------------------------------------------------------------ Q16
def unique_combination_of_columns(df: DataFrame, combination_of_columns: Sequence[str],
                                  where=None) -> Check:
    cols = [_c(c) for c in combination_of_columns]
    out = (_scope(df, where).groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
           .filter(F.col("__n") > 1).drop("__n"))
    return Check("unique_combination_of_columns", out)


# ------------------------------------------------------------------ Q18
def assert_equal(df: DataFrame, actual: str | Column, expected: str | Column, where=None) -> Check:
    a = F.expr(actual) if isinstance(actual, str) else actual
    e = F.expr(expected) if isinstance(expected, str) else expected
    return _row_check("assert_equal", df, a != e, where)


# ------------------------------------------------------------------ Q19
def columns_match_set(spark: SparkSession, df: DataFrame, column_list: Sequence[str],
                      transform: str = "upper") -> Check:
    """Column names differing between the table and the list (case folded).

    Reads the schema only: a tiny two-column frame, no scan of the data.
    """
    fold = str.upper if transform == "upper" else str.lower
    rel = [fold(c) for c in df.columns]
    inp = [fold(c) for c in column_list]
    schema = "relation_column string, input_column string"
    rows = [(r, None) for r in rel if r not in inp] + [(None, i) for i in inp if i not in rel]
    return Check("expect_table_columns_to_match_set", spark.createDataFrame(rows, schema))


# ------------------------------------------------------------------ suite
def run_suite(checks: Sequence[Check], warn_if: str = "!= 0", error_if: str = "!= 0") -> DataFrame:
    """One summary row per check: name, failures (fail_calc), status.

    All row checks of a relation are counted in one aggregate (one scan, however
    many checks); the others by an aggregate over their failures each. A check's
    own ``warn_if`` and ``error_if`` go before the suite's.
    """
    if not checks:
        raise ValueError("run_suite needs at least one check")
    parts: list[DataFrame] = []
    fused: dict[int, list[int]] = {}
    for i, ch in enumerate(checks):
        if ch.fails is not None and ch.fail_calc is None:
            fused.setdefault(id(ch.relation), []).append(i)
        else:
            parts.append(ch.failures.agg(F.coalesce(ch.count_expr(), F.lit(0)).cast("long").alias("failures"))
                         .select(F.lit(i).alias("check_index"), "failures"))
    for own in fused.values():
        counts = checks[own[0]].relation.agg(*[F.count_if(checks[i].fails).alias(f"c{i}") for i in own])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("check_index"), F.col(f"c{i}").alias("failures")) for i in own]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)

    def told(value):  # a value of each check, by its index
        return F.get(F.array(*[value(ch) for ch in checks]), F.col("check_index"))

    errs = told(lambda ch: F.expr(f"failures {ch.error_if or error_if}") & F.lit(ch.severity == "error"))
    warns = told(lambda ch: F.expr(f"failures {ch.warn_if or warn_if}"))
    status = F.when(errs, F.lit("error")).when(warns, F.lit("warn")).otherwise(F.lit("pass"))
    return out.select("check_index", told(lambda ch: F.lit(ch.name)).alias("check_name"), "failures", status.alias("status"))
