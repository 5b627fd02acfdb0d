"""Previous/next row in a total order, computed in parallel (H1).

``lag``/``lead`` over a window without (or with a huge) partition runs in a
single task. Here the rows, whole table or any mix of group sizes, are cut into
ranges of the full sort key (group columns, then order columns), whatever their
types, by Spark's own range partitioning; a row's range is the partition that it
falls into. The ranged rows are checkpointed, so everything after it sees the
same cuts and reads the input once. Each range is one window partition; the
first (or last) row of a range takes its neighbour from the nearest range that
has rows. The edges, one row for each range, are a scalar subquery: they grow
with the number of shuffle partitions, not with the data.

Inputs are expected to be unique on (partition, order columns): the checks
that use this collapse duplicate rows into counts first (``replicate``
expands them back), so a value repeated a billion times is one row here.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _sort_key(cols: Sequence[str]) -> list[Column]:
    """Ascending, NULLs last, as orderable struct fields."""
    out = []
    for i, c in enumerate(cols):
        out += [F.col(f"`{c}`").isNull().alias(f"n{i}"), F.col(f"`{c}`").alias(f"o{i}")]
    return out


def neighbour(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], value: str,
              direction: str, out: str, rows_per_range: int | None = None) -> DataFrame:
    """Add ``out`` = ``value`` of the previous (``direction='prev'``) or next
    row in order ``order_by`` (ascending, NULLs last) within ``partition_by``.

    Also adds ``out + '_exists'``: whether such a row exists. The number of ranges
    is Spark's (shuffle partitions, joined by size); ``rows_per_range`` sets it from
    a count of the rows. The ranged rows are computed and checkpointed at once.
    """
    part, prev = list(partition_by), direction == "prev"
    ensure_checkpoint_dir(df.sparkSession)
    keyed = df.withColumn("__k", F.struct(*_sort_key([*part, *order_by])))
    ranges = [] if rows_per_range is None else [max(1, -(-df.count() // rows_per_range))]
    rows = keyed.repartitionByRange(*ranges, "__k").withColumn("__range", F.spark_partition_id()).checkpoint()

    same = F.struct(*[F.col(f"`{c}`").alias(f"p{i}") for i, c in enumerate(part)], F.lit(0).alias("p"))
    held = F.struct(F.col("__k").alias("k"), same.alias("p"), F.col(f"`{value}`").alias("v"))
    edges = rows.groupBy("__range").agg((F.max if prev else F.min)(held).alias("e")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("__range").alias("r"), F.col("e")))).alias("e"))
    shift = -1 if prev else 1  # range -> edge of the nearest range with rows on that side
    pairs = F.transform("e", lambda x, i: F.struct(x["r"], F.get(F.col("e"), i + shift)["e"]))
    nearest = edges.select(F.map_from_entries(pairs).alias("m")).scalar()
    w = Window.partitionBy("__range").orderBy("__k")
    inside = (F.lag if prev else F.lead)(held).over(w)
    across = F.element_at(nearest, F.col("__range"))
    found = (rows.withColumn("__in", inside).withColumn("__p", same)
             .withColumn("__near", F.coalesce(F.col("__in"), across)))
    exists = F.col("__near").isNotNull() & F.col("__near")["p"].eqNullSafe(F.col("__p"))
    return (found.withColumn(out + "_exists", exists)
            .withColumn(out, F.when(F.col(out + "_exists"), F.col("__near")["v"]))
            .select(*[F.col(f"`{c}`") for c in df.columns], out, out + "_exists"))


CHUNK = 65536


def replicate(df: DataFrame, count: Column | str) -> DataFrame:
    """Repeat each row ``count`` times (0 -> dropped), with bounded memory.

    Rows are first split into chunks of at most ``CHUNK`` copies, the chunk
    rows are spread over the cluster, and each chunk is expanded; a row to be
    repeated a billion times is never expanded by one task.
    """
    n = F.col(count) if isinstance(count, str) else count
    cols = df.columns
    staged = df.withColumn("__n", n.cast("long")).filter(F.col("__n") > 0)
    chunks = staged.withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                        F.floor((F.col("__n") - 1) / CHUNK).cast("long"))))
    chunks = chunks.withColumn("__size", F.least(F.lit(CHUNK).cast("long"),
                                                 F.col("__n") - F.col("__chunk") * CHUNK))
    spread = chunks.repartition(*[F.col(c) for c in cols], F.col("__chunk"))
    return (spread.withColumn("__r", F.explode(F.array_repeat(F.lit(1), F.col("__size").cast("int"))))
            .select(*cols))
