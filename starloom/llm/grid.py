"""Meeting every query row with every table row, without a pair of rows: the
cells of a grid get a group of the queries and a group of the rows each, and a
task streams its rows past its queries.

With a x b cells a query is sent to b cells and a row to a, so the groups are
chosen to move the least. A cell holds at most about ``QUERIES_PER_CELL``
queries, whatever their number; rows are only ever held a block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES_PER_CELL = 16_384
ROWS_PER_BLOCK = 8192
_LONG = 1 << 63


def shape(rows: int, queries: int, cells: int, per_cell: int = QUERIES_PER_CELL) -> tuple[int, int]:
    """(a, b): groups of queries and groups of rows."""
    a = max(round((cells * queries / max(rows, 1)) ** 0.5), -(-queries // per_cell), 1)
    return a, max(1, -(-cells // a))


def in_cells(rows: DataFrame, queries: DataFrame, per_cell: int = QUERIES_PER_CELL) -> DataFrame:
    """Both (of equal columns), a partition for each cell: its queries first
    (``side`` 0), then its rows (``side`` 1). Both should be stored tables: they
    are counted."""
    a, b = shape(rows.count(), queries.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), per_cell)
    number = F.monotonically_increasing_id()
    spread = F.shiftright(number, 33) + number.bitwiseAND(F.lit((1 << 33) - 1))  # even over tasks and within one

    def dealt(df: DataFrame, side: int, groups: int, cell) -> DataFrame:
        df = df.withColumn("__g", F.pmod(spread, F.lit(groups)).cast("int")).withColumn("side", F.lit(side).cast("byte"))
        return df.withColumn("cell", F.explode(cell(F.col("__g")))).drop("__g")

    asked = dealt(queries, 0, a, lambda g: F.transform(F.sequence(F.lit(0), F.lit(b - 1)), lambda j: g * F.lit(b) + j))
    stored = dealt(rows, 1, b, lambda g: F.transform(F.sequence(F.lit(0), F.lit(a - 1)), lambda i: i * F.lit(b) + g))
    return asked.unionByName(stored).repartitionById(a * b, F.col("cell")).sortWithinPartitions("side")


def finite(vector: Column) -> Column:
    """Whether a vector has components and all of them are numbers (never null)."""
    whole = F.forall(F.transform(vector, lambda x: x.cast("double")), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def floors(vectors: pd.Series, scale: int) -> np.ndarray:
    """floor(scale * x) of all components (equal dimensions), as whole doubles:
    a double holds the product exactly, whatever the size."""
    out = np.floor(np.stack([np.asarray(v, float) for v in vectors]) * scale)
    if not np.isfinite(out).all():
        raise OverflowError("a component times the scale is beyond a double")
    return out


def exact(values: np.ndarray, other: float, dim: int) -> np.ndarray:
    """``values`` in a type whose sums of ``dim`` products with numbers up to
    ``other`` are exact: doubles, longs or Python's integers."""
    size = float(np.abs(values).max(initial=0)) * other * max(dim, 1)
    if size < 2.0 ** 52:
        return values
    if size < 2.0 ** 61 and float(np.abs(values).max(initial=0)) < 2.0 ** 61:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def as_long(score: int) -> int | None:
    """A score for a long column: None below its range (no such score can be
    among results without an error, see ``in_range``)."""
    if score >= _LONG:
        raise OverflowError(f"a score is beyond a long: {score}")
    return score if score >= -_LONG else None


def in_range(score: str) -> Column:
    """The score, or an error where it is below the range of a long."""
    return F.coalesce(F.col(score), F.raise_error(F.lit("a score is below the range of a long")).cast("long")).alias(score)


def kth_best(scores: np.ndarray, k: int):
    """The k-th largest (None if there are fewer)."""
    if len(scores) < k:
        return None
    if scores.dtype == object:
        return sorted(scores, reverse=True)[k - 1]
    return np.partition(scores, len(scores) - k)[len(scores) - k]


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (score, id), ties to the smaller id."""
    least = kth_best(scores, k)
    if least is not None:
        some = np.asarray(scores >= least, bool)
        ids, scores = ids[some], scores[some]
    return sorted(((int(s), int(i)) for s, i in zip(scores, ids)), key=lambda x: (-x[0], x[1]))[:k]


def merged(had: list[tuple[int, int]], new: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    return sorted(had + new, key=lambda x: (-x[0], x[1]))[:k] if new else had


def blocks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[tuple[int, int, pd.DataFrame]]:
    """(side, dimension, rows): all queries of a dimension together, then its
    rows at most ``size`` at a time."""
    held: dict[int, list[pd.DataFrame]] = {}
    count: dict[int, int] = {}
    before = 0

    def rest() -> Iterator[tuple[int, int, pd.DataFrame]]:
        for dim, parts in held.items():
            yield before, dim, pd.concat(parts, ignore_index=True)
        held.clear()
        count.clear()

    for batch in batches:
        for side, part in batch.groupby("side", sort=True):
            if side != before:
                yield from rest()
                before = side
            for dim, own in part.groupby(part["v"].map(len)):
                for at in range(0, len(own), size) if side else (0,):
                    piece = own.iloc[at:at + size] if side else own
                    if side and count.get(dim, 0) + len(piece) > size:
                        yield side, dim, pd.concat(held.pop(dim), ignore_index=True)
                        count[dim] = 0
                    held.setdefault(dim, []).append(piece)
                    count[dim] = count.get(dim, 0) + len(piece)
    yield from rest()
