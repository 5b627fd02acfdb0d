"""Hard negatives by a vertical scan with shrinking bounds (BOND; de Vries,
Mamoulis, Nes and Kersten, 2002).

Rows are held by column, with the least and the greatest value of each
dimension. An anchor reads the columns in descending order of its own
magnitudes. After some columns a row's score lies between its partial sum plus
the least and plus the most that the remaining columns can add; rows whose
bounds show that they are not wanted leave the candidate bitmap, and the others
go on. After the last column the partial sums are the exact scores.

Two scans: the first finds each anchor's positives (best rows of its label), the
second the best rows of other labels whose score lies in a positive's window.
Anchors and rows meet in a grid of cells (``grid``); a cell keeps the best of
each window so far, which prunes its later blocks, and returns them once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored
from .grid import ROWS_PER_BLOCK, as_long, best_of, blocks, exact, finite, floors, in_cells, kth_best, merged

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative's score is between LOWER and UPPER hundredths of the positive's.
LOWER, UPPER = 80, 100
COLUMNS_PER_STEP = 8


class ColumnBlock:
    """Rows of one dimension by column, with the range of each column."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(vectors.T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.size = float(np.abs(self.columns).max(initial=0))
        self._in = {self.columns.dtype: (self.columns, self.low, self.high)}

    def exact_for(self, anchor: np.ndarray):
        """(anchor, columns, low, high) in a type that holds every score."""
        dim = len(anchor)
        own = exact(anchor, max(self.size, 1.0), dim)
        if own.dtype not in self._in:
            kind = (lambda a: a.astype(np.int64)) if own.dtype == np.int64 else (
                lambda a: np.array([int(x) for x in a.ravel()], object).reshape(a.shape))
            self._in[own.dtype] = tuple(map(kind, (self.columns, self.low, self.high)))
        return own, *self._in[own.dtype]

    def scan(self, anchor: np.ndarray, alive: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]
             ) -> tuple[np.ndarray, np.ndarray]:
        """The rows of ``alive`` (row numbers) that stay ``wanted``, a function
        of the lower and upper bounds of their scores, and their exact scores."""
        anchor, columns, low, high = self.exact_for(anchor)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * low, anchor * high])[:, order]
        zero = np.zeros(1, anchor.dtype)
        most, least = (np.concatenate([np.cumsum(e[::-1])[::-1], zero]) for e in (ends.max(axis=0), ends.min(axis=0)))
        scores = np.zeros(len(alive), anchor.dtype)
        for at in range(0, len(order), COLUMNS_PER_STEP):
            some = order[at:at + COLUMNS_PER_STEP]
            scores = scores + anchor[some] @ columns[some[:, None], alive]
            end = min(at + COLUMNS_PER_STEP, len(order))
            left = np.asarray(wanted(scores + least[end], scores + most[end]), bool)
            if not left.all():
                alive, scores = alive[left], scores[left]
            if not len(alive):
                break
        return alive, scores


def best_wanted(had: list[tuple[int, int]], k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that may be among the ``k`` best, given the best of earlier blocks."""

    def wanted(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        left = upper >= had[-1][0] if len(had) == k else np.ones(len(upper), bool)
        least = kth_best(lower, k)
        return left if least is None else left & (upper >= least)

    return wanted


def windows_wanted(windows: list[tuple[int, int]], had: list[list[tuple[int, int]]], k: int
                   ) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that may be among the ``k`` best within one of the windows."""

    def wanted(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        left = np.zeros(len(upper), bool)
        for (low, high), best in zip(windows, had):
            may = (upper >= max(low, best[-1][0] if len(best) == k else low)) & (lower <= high)
            least = kth_best(lower[np.asarray((lower >= low) & (upper <= high), bool)], k)
            left |= np.asarray(may if least is None else may & (upper >= least), bool)
        return left

    return wanted


def window_of(positive: int, lower: int = LOWER, upper: int = UPPER) -> tuple[int, int]:
    """The least and the greatest score that a negative of ``positive`` may have."""
    return -(-lower * positive // 100), upper * positive // 100


def _scanned(pairs: DataFrame, scale: int, rows_per_block: int, found_in: Callable, schema: str) -> DataFrame:
    """Run ``found_in(block, anchor row, vector, kept)`` for every block and
    anchor of a cell; ``kept`` holds an anchor's best so far, returned at the end."""

    def cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors: dict[int, tuple[pd.DataFrame, np.ndarray, list[dict]]] = {}
        for side, dim, part in blocks(batches, rows_per_block):
            if side == 0:
                anchors[dim] = part, floors(part["v"], scale), [{} for _ in range(len(part))]
            elif dim in anchors:
                codes, names = pd.factorize(part["label"])
                block = ColumnBlock(part["id"].to_numpy(np.int64), codes, floors(part["v"], scale))
                number = {x: i for i, x in enumerate(names)}
                own, vectors, kept = anchors[dim]
                for no, label, windows, vector, best in zip(own["id"], own["label"].map(number).fillna(-1).astype(int), own["windows"], vectors, kept):
                    found_in(block, no, label, windows, vector, best)
        for own, _, kept in anchors.values():
            rows = [(a, w, i, s) for a, best in zip(own["a"], kept) for w, top in best.items() for s, i in top]
            for at in range(0, len(rows), 100_000):
                piece = rows[at:at + 100_000]
                yield pd.DataFrame({"a": [r[0] for r in piece], "w": [r[1] for r in piece], "other": [r[2] for r in piece],
                                    "score": pd.array([as_long(r[3]) for r in piece], "Int64")})

    return pairs.mapInPandas(cell, schema)


def hard_negatives(df: DataFrame, is_anchor: Column | str, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   lower: int = LOWER, upper: int = UPPER, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: int = SCALE, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """For each row of ``df`` with ``is_anchor`` (a column or SQL), and each of its ``positives``
    best other rows of the same label, the ``negatives`` best rows of other labels
    that score between ``lower`` and ``upper`` hundredths of the positive:
    anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.

    A score is the inner product of floor(scale * x), exact at any size; ties go
    to the smaller id. A returned score or a positive's score above a long is an
    error; a positive with a score below 0 has no possible negative.

    Rows whose id, label or vector is null, whose vector is empty or holds a null
    or non-finite component, take no part; only vectors of equal dimension meet.
    An anchor never meets rows of its own id. Repeated rows are rows of their own
    as positives and negatives; a repeated anchor is answered once (rows of one id
    that differ in label or vector are anchors of their own). Other columns are
    not read. Empty tables, and anchors without positives or negatives, give no
    rows.
    """
    spark = df.sparkSession
    ship(spark)
    rows = stored(df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                            F.col(vector_col).alias("v"), (F.expr(is_anchor) if isinstance(is_anchor, str) else is_anchor).alias("asked"))
                  .where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v"))), "negatives-rows")
    anchors = rows.where("asked").dropDuplicates(["id", "label", "v"]).withColumn("a", F.monotonically_increasing_id())
    anchors = stored(anchors.select("a", "id", "label", "v"), "negatives-anchors")
    none = F.lit(None).cast("array<long>").alias("windows")
    table = rows.select(F.lit(None).cast("long").alias("a"), "id", "label", "v", none)
    schema = "a long, w long, other long, score long"

    def same_label(block: ColumnBlock, no: int, label: int, _, vector: np.ndarray, best: dict) -> None:
        alive = np.flatnonzero((block.labels == label) & (block.ids != no))
        had = best.get(0, [])
        alive, scores = block.scan(vector, alive, best_wanted(had, positives))
        best[0] = merged(had, best_of(block.ids[alive], scores, positives), positives)

    def in_windows(block: ColumnBlock, no: int, label: int, tops, vector: np.ndarray, best: dict) -> None:
        alive = np.flatnonzero((block.labels != label) & (block.ids != no))
        tops = [int(t) for t in tops]
        windows = [window_of(t, lower, upper) for t in tops]
        alive, scores = block.scan(vector, alive, windows_wanted(windows, [best.get(t, []) for t in tops], negatives))
        for top, (low, high) in zip(tops, windows):
            own = np.asarray((scores >= low) & (scores <= high), bool)
            best[top] = merged(best.get(top, []), best_of(block.ids[alive[own]], scores[own], negatives), negatives)

    def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc_nulls_last("score"), "other")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = _scanned(in_cells(table, anchors.select("a", "id", "label", "v", none)), scale, rows_per_block, same_label, schema)
    chosen = stored(ranked(first, ["a"], positives).where("score >= 0")
                    .select("a", F.col("other").alias("positive_id"), F.col("score").alias("w")), "negatives-positives")
    # at most ``positives`` scores an anchor
    asked = stored(anchors.join(chosen.groupBy("a").agg(F.collect_set("w").alias("windows")), "a")
                   .select("a", "id", "label", "v", "windows"), "negatives-windows")
    second = _scanned(in_cells(table, asked), scale, rows_per_block, in_windows, schema)
    return (ranked(second, ["a", "w"], negatives).join(chosen, ["a", "w"])
            .join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
            .select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"),
                    F.col("w").alias("positive_score"), F.col("score").alias("negative_score")))
