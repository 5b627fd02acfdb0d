"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers and stored by blocks of rows; a block keeps,
for each dimension, one bitmap per bit of the (offset) value. A query adds the
slices it needs with bitmap arithmetic only: every set bit of a query component
shifts that dimension's slices, and carry-save adders (three bitmaps of one
weight become one of that weight and one of the next) sum them to the slices of
the score. The top rows are then chosen from the most significant slice down:
rows certainly in, rows still tied; the rows tied at the boundary have equal
scores and are resolved by id.

Queries and rows meet in a grid of cells (``grid``): a cell builds the index of
a block of its rows, asks it all its queries, and keeps the best k of each.
Where products may not fit a long, scores are computed in Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored
from .grid import QUERIES_PER_CELL, ROWS_PER_BLOCK, as_long, best_of, blocks, exact, finite, floors, in_cells, in_range, merged

SCALE = 1024
TOP = 10


class SlicedBlock:
    """The bit slices of ``values`` (rows x dimensions, integers), rows by id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.n = len(ids)
        self.words = -(-self.n // 64)
        shifted = (self.values - self.values.min(axis=0)).astype(np.uint64)  # not negative: plain binary slices
        self.bits = int(shifted.max()).bit_length()
        self.all = self._packed(np.ones(self.n, np.uint64))
        # slices[0, d, b]: bit b of dimension d; slices[1]: of its complement
        self.slices = np.zeros((2, shifted.shape[1], self.bits, self.words), np.uint64)
        for d in range(shifted.shape[1]):
            for bit in range(self.bits):
                self.slices[0, d, bit] = self._packed((shifted[:, d] >> np.uint64(bit)) & np.uint64(1))
        self.slices[1] = self.slices[0] ^ self.all

    def _packed(self, bit: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words * 8, np.uint8)
        raw = np.packbits(bit.astype(np.uint8), bitorder="little")
        out[:len(raw)] = raw
        return out.view(np.uint64)

    def score_slices(self, query: np.ndarray) -> list[np.ndarray | None]:
        """Slices (least first) of score(row) minus a constant of the query.

        A negative component adds the complement instead, which differs by a
        constant. All bitmaps of one weight are added a third at a time."""
        sign, size = (query < 0).astype(np.intp), np.abs(query)
        shifts = int(size.max()).bit_length() if len(size) else 0
        chosen = [np.flatnonzero(size >> j & 1) for j in range(shifts)]
        out: list[np.ndarray | None] = []
        carry = np.zeros((0, self.words), np.uint64)
        w = 0
        while (shifts and self.bits and w < shifts + self.bits - 1) or len(carry):
            pile = np.concatenate([carry, *(self.slices[sign[chosen[j]], chosen[j], w - j]
                                            for j in range(max(0, w - self.bits + 1), min(shifts, w + 1)))])
            carries = []
            while len(pile) >= 3:  # full adders
                m = len(pile) // 3
                a, b, c = pile[:m], pile[m:2 * m], pile[2 * m:3 * m]
                x = a ^ b
                carries.append((a & b) | (x & c))
                pile = np.concatenate([x ^ c, pile[3 * m:]])
            if len(pile) == 2:  # half adder
                carries.append(pile[:1] & pile[1:])
                out.append(pile[0] ^ pile[1])
            else:
                out.append(pile[0] if len(pile) else None)
            carry = np.concatenate(carries) if carries else pile[:0]
            w += 1
        return out

    def top(self, own_id, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (id, score), without the rows of ``own_id``."""
        sure = np.zeros(self.words, np.uint64)
        tied = self.all.copy()
        a, b = np.searchsorted(self.ids, own_id), np.searchsorted(self.ids, own_id, side="right")
        if b > a:
            mine = np.zeros(self.n, np.uint64)
            mine[a:b] = 1
            tied &= ~self._packed(mine)
        have = 0
        for s in reversed(self.score_slices(query)):
            if s is None:
                continue
            ones = tied & s
            n = int(np.bitwise_count(ones).sum())
            if have + n > k:
                tied = ones
            else:
                sure |= ones
                have += n
                tied &= ~s
                if have == k:
                    break
        rows = [self._rows(sure), self._rows(tied)[:k - have]]  # tied rows are in order of id
        return [(int(self.ids[r]), int(self.values[r] @ query)) for r in np.concatenate(rows)]

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=self.n, bitorder="little"))


def _top_of(block: SlicedBlock | None, ids: np.ndarray, vectors: np.ndarray, own_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of a block of whole doubles; by integers where the
    products need them."""
    if block is not None:
        return [(s, i) for i, s in block.top(own_id, query.astype(np.int64), k)]
    others = ids != own_id
    size = float(np.abs(vectors).max(initial=0))
    query = exact(query, max(size, 1.0), len(query))
    values = vectors[others] if query.dtype != object else np.array([int(x) for x in vectors[others].ravel()], object).reshape(-1, len(query))
    return best_of(ids[others], values.astype(query.dtype) @ query, k)


def top_inner_products(df: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "vec_id",
                       vector_col: str = "embedding", scale: int = SCALE, rows_per_block: int = ROWS_PER_BLOCK,
                       queries_per_block: int = QUERIES_PER_CELL) -> DataFrame:
    """The ``k`` best rows of ``df`` for each row of ``queries``: query_id, rank
    (from 1), the row's id (as ``vec_id``) and its score, best first, ties to the
    smaller id; fewer rows if there are fewer.

    A query never meets rows of its own id. Vectors that are null, empty, or
    hold null or non-finite components, and rows without an id, take no part;
    only vectors of equal dimension meet. Repeated rows of one id are rows of
    their own; a repeated query is answered once (queries of one id that differ
    are queries of their own). Scores are exact for components of any size; one
    that is returned and does not fit a long is an error. Other columns are not
    read.
    """
    spark = df.sparkSession
    ship(spark)

    def shaped(d: DataFrame) -> DataFrame:
        return d.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(
            F.col("id").isNotNull() & finite(F.col("v")))

    asked = stored(shaped(queries).dropDuplicates(["id", "v"]).select(F.monotonically_increasing_id().alias("q"), "id", "v"), "queries")
    rows = stored(shaped(df).select(F.lit(None).cast("long").alias("q"), "id", "v"), "vectors")

    def cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asks: dict[int, tuple[pd.DataFrame, np.ndarray, list]] = {}
        for side, dim, part in blocks(batches, rows_per_block):
            vectors = floors(part["v"], scale)
            if side == 0:
                asks[dim] = part, vectors, [[] for _ in range(len(part))]
            elif dim in asks:
                own, wanted, best = asks[dim]
                ids = part["id"].to_numpy(np.int64)
                size = float(np.abs(vectors).max(initial=0))
                fits = [size * float(np.abs(q).max()) * dim < 2.0 ** 61 for q in wanted]
                block = SlicedBlock(ids, vectors.astype(np.int64)) if size < 2.0 ** 61 and any(fits) else None
                for n, (i, q, fit) in enumerate(zip(own["id"], wanted, fits)):
                    best[n] = merged(best[n], _top_of(block if fit else None, ids, vectors, i, q, k), k)
        for own, _, best in asks.values():
            rows_out = [(q, i, j, as_long(s)) for q, i, top in zip(own["q"], own["id"], best) for s, j in top]
            for at in range(0, len(rows_out), 100_000):
                yield pd.DataFrame(rows_out[at:at + 100_000], columns=["q", "query_id", "vec_id", "score"]).astype({"score": "Int64"})

    found = in_cells(rows, asked, queries_per_block).mapInPandas(cell, "q long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc_nulls_last("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", in_range("score")))
