"""Join helpers for conforming and star-schema lookups.

No side is marked for broadcast unless the caller says that it is bounded: the
optimizer broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (or the adaptive one at run time) and
keeps a shuffle join otherwise.
"""

from __future__ import annotations

import itertools
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_ids = itertools.count()


def conform(df: DataFrame, mapping: DataFrame, src_col: str, map_from: str, map_to: str,
            out_col: str) -> DataFrame:
    """Left join to a code mapping (J1): many aliases -> one code; unmatched
    -> NULL. The mapping must be unique on ``map_from`` to keep the grain."""
    m = mapping.select(F.col(map_from).alias("__from"), F.col(map_to).alias(out_col))
    return (df.join(m, F.col(src_col) == F.col("__from"), "left").drop("__from"))


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[Column | str, str]],
           take: Sequence[tuple[str, str]], how: str = "left",
           one_row_per_key: bool = False, bounded: bool = False) -> DataFrame:
    """Star-schema key lookup (J4-J6): ``fact LEFT JOIN dim`` on equality of
    fact expressions and dim columns; brings ``take`` = [(dim_col, out_name)].

    Plain ``=`` semantics: a NULL on either side never matches (J5). Computed
    fact expressions are materialised as columns first, so the join stays an
    equi-join (hash or sort-merge), never a nested loop. A key with several
    rows multiplies the fact's rows as SQL does; with ``one_row_per_key`` the
    least of its ``take`` values is used instead. ``bounded``: the dimension is small
    by what it is (a calendar, a seed, combinations of labels), however many facts
    there are, so that the facts need not be shuffled until it has been measured.
    """
    tag = f"__d{next(_ids)}"
    keys = [f"{tag}_dk{i}" for i in range(len(on))]
    made = [(f"{tag}_fk{i}", x) for i, (x, _) in enumerate(on)]
    f = fact.select("*", *[(F.col(x) if isinstance(x, str) else x).alias(n) for n, x in made])
    d = dim.select(*[F.col(dcol).alias(k) for k, (_, dcol) in zip(keys, on)],
                   *[F.col(src).alias(dst) for src, dst in take])
    if one_row_per_key:
        d = d.groupBy(*keys).agg(F.min(F.struct(*[dst for _, dst in take])).alias(f"{tag}_t")).select(
            *keys, *[F.col(f"{tag}_t")[dst].alias(dst) for _, dst in take])
    cond = reduce(lambda a, b: a & b, [F.col(n) == F.col(k) for (n, _), k in zip(made, keys)])
    return f.join(F.broadcast(d) if bounded else d, cond, how).select(*[F.col(f"`{c}`") for c in fact.columns], *[dst for _, dst in take])


def lookup_from_afar(fact: DataFrame, dim: DataFrame, key: str, dim_key: str,
                     take: Sequence[tuple[str, str]], at: str) -> DataFrame:
    """``lookup`` of ``key`` in a dimension that may be large, where the rows of
    ``fact`` lie together by ``at``: the distinct pairs of ``at`` and ``key`` go to the
    dimension, and what they find comes back to ``at``. The wide rows stay where they
    lie and as they are sorted. A text that is the lower-case hexadecimal form of some
    bytes, as surrogate keys are, comes back as these bytes, half as long. ``at`` must
    not be NULL (such a row finds nothing)."""
    tag = f"__d{next(_ids)}"
    pairs = fact.select(F.col(at).alias(f"{tag}_at"), F.col(key).alias(f"{tag}_key")).distinct()
    found = lookup(pairs, dim, [(f"{tag}_key", dim_key)], take, how="inner")
    texts = {c: f"{tag}_b{i}" for i, (c, kind) in enumerate(found.dtypes) if kind == "string" and c in {dst for _, dst in take}}
    is_hex = {c: F.coalesce(F.lower(F.hex(F.unhex(c))) == F.col(c), F.lit(False)) for c in texts}
    found = found.select(*[F.when(~is_hex[c], F.col(c)).alias(c) if c in texts else F.col(c) for c in found.columns],
                         *[F.when(is_hex[c], F.unhex(c)).alias(b) for c, b in texts.items()])
    cond = (F.col(at) == F.col(f"{tag}_at")) & (F.col(key) == F.col(f"{tag}_key"))
    return fact.join(found, cond, "left").select(
        *[F.col(f"`{c}`") for c in fact.columns],
        *[F.coalesce(F.col(dst), F.lower(F.hex(texts[dst]))).alias(dst) if dst in texts else F.col(dst) for _, dst in take])


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``WHERE k IN (SELECT k ...)``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a partner."""
    return df.join(keys.select(*on), list(on), "left_anti")


def natural_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on every shared column name (J12): rows with a NULL in a
    shared column never match."""
    shared = [c for c in a.columns if c in set(b.columns)]
    if not shared:
        raise ValueError("natural_join: no shared columns")
    return a.join(b, shared, "inner")


def other_side(df: DataFrame, group_cols: Sequence[str], side_col: str,
               value_cols: Sequence[str], prefix: str = "o_") -> DataFrame:
    """Pair each row with the rows of the same group whose ``side_col``
    differs (J7: ``a.g = b.g AND a.side != b.side``).

    A plain equi-join on the group with the sides' difference as residual:
    both inputs have one shuffle on the group, and a hot group is split by the
    adaptive skew join. Adds ``prefix + side_col`` and ``prefix + v`` for each
    value column. Rows with a NULL group or side have no partner.
    """
    other = df.select(*[F.col(c).alias(f"__k_{c}") for c in group_cols], F.col(side_col).alias(prefix + side_col),
                      *[F.col(v).alias(prefix + v) for v in value_cols])
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__k_{c}") for c in group_cols])
    return (df.join(other, cond & (F.col(side_col) != F.col(prefix + side_col)), "inner")
            .select(*df.columns, prefix + side_col, *[prefix + v for v in value_cols]))
