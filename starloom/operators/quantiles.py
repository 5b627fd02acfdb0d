"""Exact quantiles by narrowing ranges (P7 with thresholds from the data).

A sketch of the column cuts it into ranges of about equal counts; exact counts
say which range holds the wanted rank; its rows are cut again, and only the
values of the last, narrow range are put in order. Every step is part of one lazy
plan (scalar subqueries): no job runs while it is built, nothing is sorted as a
whole, and what reaches one task is the range of one quantile, a small share of
the rows unless they are one value.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of a cut, the sketch's accuracy (its error is a tenth of a range), ranges
#: kept around the wanted one, and how often the column is cut.
RANGES, ACCURACY, MARGIN, CUTS = 1000, 10_000, 3, 2


def _bracket(sketch: Column, n: Column, rank: Column) -> Column:
    """Bounds that hold the value of ``rank`` (from 0) of ``n``."""
    at = F.floor(rank / n * RANGES).cast("int")
    return F.struct(F.get(sketch, F.greatest(at - MARGIN, F.lit(0))).alias("low"),
                    F.get(sketch, F.least(at + MARGIN + 1, F.lit(RANGES))).alias("high"), rank.alias("rank"))


def exact_quantiles(df: DataFrame, column: str, quantiles: Sequence[float]) -> DataFrame:
    """One row, one column ``quantiles``: for each the least value that at least this
    share of the values does not exceed (the discrete quantile; null without values).

    Nulls and NaN are no values. The column is numeric."""
    cut = F.lit([i / RANGES for i in range(RANGES + 1)])
    value = F.col(f"`{column}`")
    rows = df.select(value.alias("v"), value.cast("double").alias("d")).where(F.col("d").isNotNull() & ~F.isnan("d"))
    d, i = F.col("d"), F.col("i")

    def sketch() -> Column:
        return F.percentile_approx(d, cut, ACCURACY)

    def rank(q: float) -> Column:
        return F.greatest(F.ceil(F.lit(Decimal(str(q))) * F.col("n")).cast("long") - 1, F.lit(0).cast("long"))

    def by_quantile(found: DataFrame, what: Column) -> Column:
        """``what`` of each quantile ``i``, as a map (as many entries as quantiles)."""
        return found.agg(F.map_from_entries(F.collect_list(F.struct("i", what)))).scalar()

    whole = rows.agg(F.count(F.lit(1)).alias("n"), sketch().alias("s"))
    brackets = whole.select(F.array(*[_bracket(F.col("s"), F.col("n"), rank(q)) for q in quantiles])).scalar()
    every = F.array(*[F.lit(k) for k in range(len(quantiles))])
    rows = rows.withColumn("b", brackets)
    below = rows.agg(F.array(*[F.count_if(d < F.get("b", F.lit(k))["low"]) for k in range(len(quantiles))])).scalar()
    inside = F.filter(every, lambda k: (d >= F.get("b", k)["low"]) & (d <= F.get("b", k)["high"]))
    rows = rows.withColumn("i", F.explode(inside)).select("v", "d", "i", (F.get("b", i)["rank"] - F.get(below, i)).alias("rank"))
    for _ in range(CUTS - 1):
        own = rows.groupBy("i").agg(F.count(F.lit(1)).alias("n"), sketch().alias("s"), F.max("rank").alias("rank"))
        cut_again = by_quantile(own.select("i", _bracket(F.col("s"), F.col("n"), F.col("rank")).alias("b")), F.col("b"))
        rows = rows.withColumn("b", F.element_at(cut_again, i))
        less = by_quantile(rows.groupBy("i").agg(F.count_if(d < F.col("b.low")).alias("n")), F.col("n"))
        rows = rows.where((d >= F.col("b.low")) & (d <= F.col("b.high"))).select("v", "d", "i", (F.col("rank") - F.element_at(less, i)).alias("rank"))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("v"))
    chosen = (rows.groupBy("i", "v", "rank").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
              .where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))))
    return chosen.agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m")).select(
        F.transform(every, lambda k: F.element_at("m", k)).alias("quantiles"))


def quantile_columns(df: DataFrame, column: str, quantiles: Sequence[float]) -> list[Column]:
    """The exact quantiles as columns (scalar subqueries) for use in any query, for
    example as the cuts of ``quartile_label``. Nothing is computed yet."""
    found = exact_quantiles(df, column, quantiles).scalar()
    return [F.get(found, F.lit(k)) for k in range(len(quantiles))]
