"""Generated series: number series, date spines, single values.

Every generator takes its bounds from a one-row DataFrame (usually an
aggregate of the data), so the plan stays lazy: no value is collected to the
driver to paste into a second query. The generated length is bounded by the
range (days between two dates, a count), not by the table size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordered import CHUNK

_PARTS = ("day", "week", "month", "quarter", "year", "hour", "minute", "second")


def intervals_between(start, end, datepart: str) -> Column:
    """Number of whole ``datepart`` boundaries from ``start`` to ``end``.

    day: date difference; week: days div 7; month/quarter/year: calendar
    fields, ignoring the day (as a SQL ``datediff`` on parts does); hour,
    minute, second: difference of the truncated times.
    """
    s = start if isinstance(start, Column) else F.lit(start)
    e = end if isinstance(end, Column) else F.lit(end)
    p = datepart.lower()
    if p == "day":
        return F.datediff(e.cast("date"), s.cast("date"))
    if p == "week":
        return F.floor(F.datediff(e.cast("date"), s.cast("date")) / 7).cast("int")
    months = (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))
    if p == "month":
        return months
    if p == "quarter":
        return (F.year(e) - F.year(s)) * 4 + (F.quarter(e) - F.quarter(s))
    if p == "year":
        return F.year(e) - F.year(s)
    if p in ("hour", "minute", "second"):
        # wall-clock times (timestamp_ntz): no session time zone applies
        def since_epoch(x):
            trunc = F.date_trunc(p, x.cast("timestamp_ntz")).cast("timestamp_ntz")
            return F.timestamp_diff(p.upper(), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), trunc)
        return (since_epoch(e) - since_epoch(s)).cast("long")
    raise ValueError(f"datepart must be one of {_PARTS}")


def _add(start: Column, n: Column, datepart: str) -> Column:
    p = datepart.lower()
    if p == "day":
        return F.date_add(start.cast("date"), n.cast("int"))
    if p == "week":
        return F.date_add(start.cast("date"), (n * 7).cast("int"))
    if p == "month":
        return F.add_months(start.cast("date"), n.cast("int"))
    if p == "quarter":
        return F.add_months(start.cast("date"), (n * 3).cast("int"))
    if p == "year":
        return F.add_months(start.cast("date"), (n * 12).cast("int"))
    if p in ("hour", "minute", "second"):
        return F.timestamp_add(p.upper(), n, start.cast("timestamp_ntz"))
    raise ValueError(f"datepart must be one of {_PARTS}")


def date_spine(bounds: DataFrame, start: str | Column, end: str | Column,
               datepart: str = "day") -> DataFrame:
    """One row per ``datepart`` from ``start`` (included) to ``end`` (excluded
    when on a boundary), column ``date_<datepart>`` (G1).

    ``bounds`` is a one-row DataFrame holding the two values.
    """
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    name = f"date_{datepart.lower()}"
    n = intervals_between(s, e, datepart)
    steps = _numbered(bounds.select(s.alias("__s"), e.alias("__e"), n.cast("long").alias("__n")), "__n", "__i")
    return (steps.select(_add(F.col("__s"), F.col("__i"), datepart).alias(name), "__e")
            .filter(F.col(name) <= F.col("__e")).select(name))


def _numbered(rows: DataFrame, count: str, name: str) -> DataFrame:
    """Each row once for every number 0 .. ``count`` - 1 (column ``name``): in chunks of
    at most CHUNK numbers, spread over the cluster before they are expanded, so
    that no single row or task holds a whole series."""
    n = F.col(count)
    chunks = rows.where(n > 0).withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / CHUNK).cast("long"))))
    low = F.col("__chunk") * CHUNK
    return (chunks.repartition("__chunk")
            .withColumn(name, F.explode(F.sequence(low, F.least(n, low + CHUNK) - 1))).drop("__chunk"))


def day_series_inclusive(bounds: DataFrame, start: str, end: str,
                         name: str = "date_day") -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    days = bounds.select(first.alias("__s"), (F.datediff(last, first) + 1).cast("long").alias("__n"))
    return _numbered(days, "__n", "__i").select(F.date_add("__s", F.col("__i").cast("int")).alias(name))


def generate_series(bounds: DataFrame | SparkSession, upper) -> DataFrame:
    """Numbers 1..n in column ``generated_number`` (G2); n <= 0 is an error.

    With a SparkSession and an int, ``spark.range`` does it in parallel; with
    a one-row DataFrame the bound is a column of it.
    """
    if isinstance(bounds, SparkSession):
        if int(upper) <= 0:
            raise ValueError("generate_series: upper bound must be positive")
        return bounds.range(1, int(upper) + 1).select(F.col("id").alias("generated_number"))
    u = F.col(upper) if isinstance(upper, str) else upper
    checked = F.when(u > 0, u).otherwise(
        F.raise_error(F.lit("generate_series: upper bound must be positive"))).cast("long")
    return _numbered(bounds.select(checked.alias("__n")), "__n", "__i").select((F.col("__i") + 1).alias("generated_number"))


def single_value(df: DataFrame, default=None) -> DataFrame:
    """First column of a (one-row) query as a one-row DataFrame ``value``;
    ``default`` only when the query has no row: a NULL stays NULL (G4). Of
    several rows one is taken, as the query's order or limit decides."""
    first = df.columns[0]
    one = df.select(F.col(f"`{first}`").alias("value")).limit(1).agg(
        F.count(F.lit(1)).alias("n"), F.any_value("value").alias("value"))
    if default is None:
        return one.select("value")
    return one.select(F.when(F.col("n") == 0, F.lit(default)).otherwise(F.col("value")).alias("value"))
