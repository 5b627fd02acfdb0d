"""SimHash near-duplicates by covering locality-sensitive hashing (Pagh, 2016).

A fingerprint bit is the majority of that bit over the hashes of all word
shingles. For radius r every bit position i gets a vector a(i) in F2^(r+1);
table v (one per non-zero v, 2^(r+1)-1 in all) keys a fingerprint by the bits
with <a(i), v> = 1. The at most r differing bits of a linked pair span a proper
subspace, so some v is orthogonal to all of them and the pair shares that
table's key: no link is missed.

Copies collapse to one row per distinct fingerprint before the tables. A bucket
gives the edges of its spanning stars, never its pairs; large buckets are cut
again by covering masks over the bits still free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_udf_of, free_name, ship, stored
from .components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
_DIRECT = 2048
_BITS = 64


def fingerprint_of(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint; 0 for a text without words (or null)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(_BITS, np.int64)
    for at in range(0, n, 1 << 15):
        h = np.array([digest(flat[s:e], 42) for s, e in zip(starts[at:at + (1 << 15)], stops[at:at + (1 << 15)])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of ``text`` as a (signed) long."""

    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], np.uint64).view(np.int64))

    return arrow_udf_of(rows, "long")(text)


def covering_masks(radius: int, free: int = (1 << _BITS) - 1) -> list[int]:
    """The key masks of all tables, over the bits set in ``free``."""
    n_vectors = (1 << (radius + 1)) - 1
    bits = [i for i in range(_BITS) if free >> i & 1]
    vector = {b: 1 + k % n_vectors for k, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() & 1) for v in range(1, n_vectors + 1)]


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of two or more equal values in sorted ``keys``."""
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    for i in np.flatnonzero(np.diff(cut) > 1):
        yield int(cut[i]), int(cut[i + 1])


def bucket_links(fps: np.ndarray, radius: int, free: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Star edges that connect what pairs within ``radius`` connect among the
    distinct ``fps``, which differ only in the bits of ``free``."""
    if len(fps) > _DIRECT and free.bit_count() > 2 * (radius + 1):
        out = []
        for mask in covering_masks(radius, free):
            keys = fps & np.uint64(mask)
            order = np.argsort(keys, kind="stable")
            for a, b in _runs(keys[order]):
                if b - a < len(fps):
                    out += bucket_links(fps[order[a:b]], radius, free & ~mask)
                else:
                    out += _breadth_first(fps, radius)
        return out
    return _breadth_first(fps, radius)


def _breadth_first(fps: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out, rest = [], fps
    while len(rest) > 1:
        seed, rest = rest[0], rest[1:]
        front, found = [seed], []
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= radius
            if near.any():
                front += list(rest[near])
                found.append(rest[near])
                rest = rest[~near]
        if found:
            tree = np.concatenate(found)
            out.append((np.full(len(tree), seed), tree))
    return out


def near_links(fps: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) that connect the distinct long fingerprints of ``fps`` (column
    fp) exactly as the links within ``radius`` bits do."""
    ship(fps.sparkSession)
    masks = covering_masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = F.explode(F.array(*[F.struct(F.lit(t).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                                 for t, m in enumerate(signed)]))
    every = (1 << _BITS) - 1

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[np.ndarray] = []  # the last bucket, which may go on in the next batch
        last = None

        def closed(t: int, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
            return bucket_links(own, radius, every & ~masks[t]) if len(own) > 1 else []

        def frame(found: list) -> pd.DataFrame:
            u, v = (np.concatenate(x).view(np.int64) for x in zip(*found))
            return pd.DataFrame({"u": u, "v": v})

        for batch in batches:
            t, k, fp = batch["t"].to_numpy(), batch["k"].to_numpy(), batch["fp"].to_numpy(np.int64).view(np.uint64)
            if not len(fp):
                continue
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])
            cut = np.append(np.flatnonzero(new), len(fp))
            first = 0
            found = []
            if last == (t[0], k[0]):
                kept.append(fp[:cut[1]])
                first = 1
            if first < len(cut) - 1:  # another bucket begins: the carried one is complete
                if kept:
                    found += closed(last[0], np.concatenate(kept))
                size = np.diff(cut)
                pairs = np.flatnonzero(size[first:-1] == 2) + first
                a, b = fp[cut[pairs]], fp[cut[pairs] + 1]
                near = np.bitwise_count(a ^ b) <= radius
                found.append((a[near], b[near]))
                for i in np.flatnonzero(size[first:-1] > 2) + first:
                    found += closed(t[cut[i]], fp[cut[i]:cut[i + 1]])
                last = (t[cut[-2]], k[cut[-2]])
                kept = [fp[cut[-2]:].copy()]
            if found:
                yield frame(found)
        if kept and (found := closed(last[0], np.concatenate(kept))):
            yield frame(found)

    return (fps.select("fp", tables.alias("b")).select("b.t", "b.k", "fp")
            .repartition("t", "k").sortWithinPartitions("t", "k", "fp")
            .mapInPandas(links, "u long, v long"))


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links.

    Texts without words (null, empty) have fingerprint 0 and link like any
    other. Rows with equal ids each get their row. A null id never becomes a
    component id unless its whole component has none. Other columns are not read.
    """
    rows = stored(df.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash")
    named = _rooted(rows, radius)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "root").select("fp", "component_id")
    return rows.join(of_class, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _rooted(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, least, root): each fingerprint of ``rows`` (id, fp), its smallest id and
    the least fingerprint of its component."""
    classes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(near_links(classes, radius))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def keep_one_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                  radius: int = MAX_BITS) -> DataFrame:
    """``df`` with one row of each component, all its columns: the row of the
    smallest id; of several such rows (of one id and one component) the one whose
    columns hash least, once if it is repeated. Rows without an id stay."""
    h1, h2 = (free_name(df, x) for x in ("row_hash", "row_hash_2"))
    every = [F.sort_array(F.map_entries(F.col(f"`{f.name}`"))) if f.dataType.typeName() == "map" else F.col(f"`{f.name}`") for f in df.schema]
    signed = df.withColumn(h1, F.xxhash64(*every)).withColumn(h2, F.xxhash64(F.lit("second"), *reversed(every)))
    rows = stored(signed.select(
        F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp"), F.col(h1).alias("h1"), F.col(h2).alias("h2")), "simhash-rows")
    least = rows.where("id IS NOT NULL").groupBy("fp").agg(F.min(F.struct("id", "h1", "h2")).alias("w"))  # of all copies, in every task
    first = least.join(_rooted(rows, radius).select("fp", "root"), "fp").groupBy("root").agg(F.min("w").alias("w"))
    winners = stored(first.select(F.col("w.h1").alias(h1), F.col("w.h2").alias(h2)), "simhash-winners")
    # both steps deal rows by the same two columns: texts are shuffled once
    kept = signed.join(winners, [h1, h2], "left_semi").dropDuplicates([h1, h2])
    return kept.select(*df.columns).unionByName(df.where(F.col(id_col).isNull()))
