"""Near-duplicate vectors by a pivot-permutation index (Amato and Savino, 2008;
Esuli, 2012; lists of shared pivots: Tellez, Chavez and Navarro, 2013).

Reference points (pivots) are chosen once from a bounded sample. Every vector is
described by the ordered list of its ``NEAREST`` closest pivots. Two vectors are
a candidate pair if their lists share at least ``SHARED`` pivots; near vectors
share most of theirs, others next to none.

Retrieval is by inverted lists. With NEAREST - SHARED pivots allowed to differ,
the three smallest pivots (by number, rarest first) that a candidate pair shares
lie among the NEAREST - SHARED + 3 smallest of each, so a list for each triple of
these brings every candidate pair together, and long lists are rare. A pair is
counted in one list only, that of its three smallest shared pivots. In a list the
numbers of shared pivots come from bitmaps; only vectors that have a candidate
there are joined with their components, and each candidate's cosine is verified.

Pivots are at least three times a link's angle apart. Where the sample has no more
than NEAREST such (few dimensions, one narrow cone), every pair is a candidate:
results stay whole, and the work is that of all pairs, in blocks.

Equal vectors of a label are one class with a count before any of this. Lists
longer than a block are cut into blocks which meet pairwise in tasks of their
own. Pairs stay inside a task: it returns the number of links of each class and
the edges of a spanning forest, both linear in its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .components import components
from .grid import finite

LEAST_COSINE = 0.98
PIVOTS = 256
#: Rows that the pivots are chosen from, at most (those of the smallest hashes).
SAMPLE_ROWS = 4096
#: Length of a vector's pivot list, and how many pivots a candidate pair shares. Of
#: the pairs at 0.98 or more 99.7 % or more share 5 of 10 in simulations with random
#: vectors, groups, and narrow cones of 4 to 256 dimensions; of unrelated random
#: pairs of 64 dimensions 4 in a million do.
NEAREST = 10
SHARED = 5
ROWS_PER_BLOCK = 1024
ROWS_AT_ONCE = 16_384
_WORDS = PIVOTS // 64


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 (rows, not zero), without overflow or underflow: scaled by a
    power of two first."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    scaled = np.ldexp(vectors, -power)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def choose_pivots(sample: np.ndarray, n: int = PIVOTS, least_cosine: float = LEAST_COSINE) -> np.ndarray:
    """At most ``n`` pivots of the sample's unit vectors, each the one farthest from
    those before it, none within three times the angle of a link of another:
    pivots inside a group of near vectors would tear its lists apart. The rarest, those
    nearest to the fewest of the sample, come first."""
    if not len(sample):
        return sample
    chosen, at = [], 0
    nearest = np.full(len(sample), -np.inf)
    while len(chosen) < n:
        chosen.append(sample[at])
        nearest = np.maximum(nearest, sample @ sample[at])
        at = int(nearest.argmin())
        if nearest[at] > 4 * least_cosine ** 3 - 3 * least_cosine:
            break
    pivots = np.array(chosen)
    used = np.bincount(ordered_pivots(sample, pivots).ravel(), minlength=n)[:len(pivots)]
    return pivots[np.argsort(used, kind="stable")]


def ordered_pivots(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The numbers of the NEAREST pivots of each row, nearest first. With no more
    pivots than that, all rows have all of them (and numbers that no pivot has)."""
    if len(pivots) <= NEAREST:
        near = np.full((len(units), NEAREST), np.inf)
        near[:, :len(pivots)] = -(units @ pivots.T) if len(pivots) else 0
        return np.argsort(near, axis=1, kind="stable")
    near = -(units @ pivots.T)
    some = np.argpartition(near, NEAREST, axis=1)[:, :NEAREST]
    order = np.argsort(np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


_TRIPLES = np.array(list(combinations(range(NEAREST - SHARED + 3), 3)))


def list_keys(lists: np.ndarray) -> np.ndarray:
    """For each row of pivot numbers the keys of its inverted lists."""
    smallest = np.sort(lists, axis=1)[:, :NEAREST - SHARED + 3]
    a, b, c = (smallest[:, t] for t in _TRIPLES.T)
    return (a * PIVOTS + b) * PIVOTS + c


def bitmaps(lists: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lists), _WORDS), np.uint64)
    for col in lists.T:
        np.bitwise_or.at(out, (np.arange(len(lists)), col >> 6), np.uint64(1) << (col & 63).astype(np.uint64))
    return out


def _before(keys: np.ndarray) -> np.ndarray:
    """For each key, a bitmap of the pivots below its last one, without its other two:
    a pair that shares none of these has this key as its three smallest."""
    a, b, c = keys // PIVOTS ** 2, keys // PIVOTS % PIVOTS, keys % PIVOTS
    word = np.arange(_WORDS)[None, :] * 64
    n = np.clip(c[:, None] - word, 0, 64)
    full = n == 64
    out = np.where(full, np.uint64(2 ** 64 - 1), (np.uint64(1) << np.where(full, 0, n).astype(np.uint64)) - np.uint64(1))
    rows = np.arange(len(keys))
    for x in (a, b):
        out[rows, x >> 6] &= ~(np.uint64(1) << (x & 63).astype(np.uint64))
    return out


def candidate_pairs(run: np.ndarray, side: np.ndarray, keys: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers in one run that share SHARED pivots or more and whose
    three smallest shared pivots are the run's key. ``run`` is ascending; rows of
    sides 1 and 2 of a run meet those of the other side only, of side 0 all."""
    before = _before(keys)
    size = np.diff(np.append(np.flatnonzero(np.append(True, run[1:] != run[:-1])), len(run)))
    left = np.concatenate([np.arange(s, 0, -1) for s in size]) - 1 if len(size) else size  # rows after it in its run
    for step in range(1, int(size.max(initial=1))):
        x = np.flatnonzero(left >= step)
        y = x + step
        x, y = (z[(side[x] == 0) | (side[x] != side[y])] for z in (x, y))
        both = bits[x] & bits[y]
        ok = (np.bitwise_count(both).sum(axis=1) >= SHARED) & ~(both & before[x]).any(axis=1)
        if ok.any():
            yield x[ok], y[ok]


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the least row that the pairs (x, y) connect it to."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        np.minimum.at(new, root[x], least)
        np.minimum.at(new, root[y], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


_CELL = ["label", "dim", "key", "i", "j"]


def _whole_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows again, in frames that cut no cell and hold one dimension each."""
    held: list[pd.DataFrame] = []
    n = 0

    def by_dim(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, own in rows.groupby("dim", sort=False):
            yield own.reset_index(drop=True)

    for b in batches:
        if not len(b):
            continue
        held.append(b)
        n += len(b)
        if n < ROWS_AT_ONCE:
            continue
        rows = pd.concat(held, ignore_index=True)
        differs = (rows[_CELL] != rows[_CELL].iloc[-1]).any(axis=1).to_numpy()
        open_from = int(np.flatnonzero(differs).max(initial=-1)) + 1
        yield from by_dim(rows.iloc[:open_from])
        held, n = [rows.iloc[open_from:]], len(rows) - open_from
    if held:
        yield from by_dim(pd.concat(held, ignore_index=True))


def _pairs_of(part: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    cells = part[_CELL]
    run = np.cumsum((cells != cells.shift()).any(axis=1).to_numpy())
    i, j, own = (part[c].to_numpy(np.int64) for c in ("i", "j", "block"))
    side = np.where(i == j, 0, np.where(own == i, 1, 2))
    lists = np.frombuffer(b"".join(part["near"]), np.uint8).reshape(-1, NEAREST).astype(np.int64)
    return candidate_pairs(run, side, part["key"].to_numpy(np.int64), bitmaps(lists))


def _with_candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The postings that have a candidate in their cell."""
    for part in _whole_cells(batches):
        some = np.zeros(len(part), bool)
        for x, y in _pairs_of(part):
            some[x] = some[y] = True
        yield part[some]


def _links(batches: Iterator[pd.DataFrame], least_cosine: float) -> Iterator[pd.DataFrame]:
    """Verified links: for each class of a cell the rows it links to there, and a
    class of its tree."""
    for part in _whole_cells(batches):
        n, cid = part["n"].to_numpy(np.int64), part["cid"].to_numpy(np.int64)
        units = unit(np.stack([np.asarray(v, float) for v in part["v"]]))
        count = np.zeros(len(part), np.int64)
        found = []
        for x, y in _pairs_of(part):
            near = np.einsum("ij,ij->i", units[x], units[y]) >= least_cosine
            found.append((x[near], y[near]))
        if found:
            x, y = (np.concatenate(z) for z in zip(*found))
            np.add.at(count, x, n[y])
            np.add.at(count, y, n[x])
            some = np.flatnonzero(count)
            yield pd.DataFrame({"cid": cid[some], "links": count[some], "other": cid[forest(len(part), x, y)[some]]})


def _sample_pivots(classes: DataFrame, least_cosine: float) -> dict[int, np.ndarray]:
    """Pivots for each dimension that the sample holds (bounded by SAMPLE_ROWS)."""
    rows = classes.select("v").orderBy(F.xxhash64("h1", "h2"), "h1", "h2").limit(SAMPLE_ROWS).collect()
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r.v), []).append(r.v)
    return {d: choose_pivots(unit(np.array(v, float)), least_cosine=least_cosine) for d, v in by_dim.items()}


def near_duplicate_vectors(df: DataFrame, least_cosine: float = LEAST_COSINE, id_col: str = "vec_id",
                           vector_col: str = "embedding", label_col: str = "label",
                           rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """One row per row of ``df``: its id, ``n_links`` (other rows linked to it
    directly), ``component_id`` (smallest id reachable by links, itself included)
    and ``kept`` (it has that id).

    Rows of equal, non-null labels link if their cosine, in doubles, is at least
    ``least_cosine``. Every link returned is verified; of the links that exist
    nearly all are found (``SHARED``), among equal vectors all. A row whose label
    or vector is null, or whose vector is empty, zero or holds a null or non-finite
    component, links with nothing; vectors of unequal dimension do not link.
    Repeated rows are rows of their own. A null id is never a component id unless
    all ids of its component are null; such a row is kept only if it is alone or all
    are. Other columns are not read; an empty table gives no rows.
    """
    spark = df.sparkSession
    ship(spark)
    v = F.col(vector_col)
    takes_part = F.col(label_col).isNotNull() & finite(v) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = stored(df.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"), takes_part.alias("ok"))
                  .select("id", "ok", "label", F.when(F.col("ok"), F.col("v")).alias("v"),
                          F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit("second"), "v", "label").alias("h2")), "vectors-rows")
    classes = stored(rows.where("ok").groupBy("h1", "h2")
                     .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.first("label").alias("label"), F.first("v").alias("v"))
                     .withColumn("cid", F.monotonically_increasing_id()), "vectors-classes")
    pivots = _sample_pivots(classes, least_cosine)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, own in b.groupby(b["v"].map(len)):
                near = ordered_pivots(unit(np.stack([np.asarray(x, float) for x in own["v"]])), pivots.get(dim, np.zeros((0, dim))))
                yield pd.DataFrame({"cid": own["cid"], "label": own["label"], "dim": dim,
                                    "near": [x.tobytes() for x in near.astype(np.uint8)], "keys": list(list_keys(near).astype(np.int32))})

    index = stored(classes.select("cid", "label", "v").mapInPandas(describe, "cid long, label string, dim int, near binary, keys array<int>"),
                   "vectors-index")
    postings = index.select("label", "dim", F.explode("keys").alias("key"), "cid", "near")
    sizes = postings.groupBy("label", "dim", "key").count().where("count > 1").select(
        "label", "dim", "key", F.ceil(F.col("count") / rows_per_block).cast("int").alias("blocks"))
    cells = (postings.join(sizes, ["label", "dim", "key"])
             .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("label", "dim", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "near"))

    def together(d: DataFrame) -> DataFrame:
        return d.repartition(*_CELL).sortWithinPartitions(*_CELL)

    some = stored(together(cells).mapInPandas(_with_candidates, cells.schema), "vectors-candidates")
    linked = together(some.join(classes.select("cid", "n", "v"), "cid"))
    found = stored(linked.mapInPandas(lambda b: _links(b, least_cosine), "cid long, links long, other long"), "vectors-links")

    roots = components(found.select(F.col("cid").alias("u"), F.col("other").alias("v")))
    named = (classes.select("cid", "h1", "h2", "n", "least").join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
             .withColumn("root", F.coalesce("root", "cid"))
             .join(found.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "root").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linking = rows.where("ok").select("id", "h1", "h2").join(of_class, ["h1", "h2"]).select("id", "n_links", "component_id")
    alone = rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linking.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                             F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
