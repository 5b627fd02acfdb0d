"""One row per key: deduplicate, latest/first per key.

Two plans are offered:

* ``aggregate`` (default): ``groupBy(key).agg(min(struct(order..., row)))``.
  The aggregate is partial (map-side combine), so a key that holds a third
  of all rows is reduced inside every map task before the shuffle; no task
  ever sorts a whole hot key. Used when every order column can be expressed
  in one direction or turned round (numbers, dates, timestamps, texts).
* ``window``: ``row_number()`` over the key, the textbook plan; a hot key
  lands in one task. Kept for order specs the aggregate cannot encode.

Ties on the order columns are broken by the whole row (ascending, NULLs
first) so the result is deterministic; the reference leaves ties arbitrary.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Order:
    col: str
    desc: bool = False
    nulls_first: bool | None = None  # None = PostgreSQL default (last asc, first desc)

    @property
    def nulls_first_eff(self) -> bool:
        return self.desc if self.nulls_first is None else self.nulls_first

    def sort_col(self) -> Column:
        c = F.col(f"`{self.col}`")
        if self.desc:
            return c.desc_nulls_first() if self.nulls_first_eff else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first_eff else c.asc_nulls_last()


def _orders(order_by: Sequence[Order | str]) -> list[Order]:
    return [o if isinstance(o, Order) else Order(o) for o in order_by]


_NEGATABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
              T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType,
              T.StringType, T.BinaryType, T.BooleanType)


#: Types whose equal values are the same (0.0 and -0.0 are not, nor collated texts).
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType,
          T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)


def _exact(dt: T.DataType | None) -> bool:
    return isinstance(dt, _EXACT) or dt == T.StringType()


def _ascending_key(o: Order, dt: T.DataType, flip: bool) -> list[Column] | None:
    """Components whose ascending struct order equals ``o`` (or its reverse
    when ``flip``); None when the type cannot be negated."""
    c = F.col(f"`{o.col}`")
    want_desc = o.desc != flip
    nulls_first = o.nulls_first_eff if not flip else not o.nulls_first_eff
    null_rank = c.isNotNull() if nulls_first else c.isNull()
    if not want_desc:
        return [null_rank, c]
    if not isinstance(dt, _NEGATABLE):
        return None
    if isinstance(dt, (T.StringType, T.BinaryType)):
        # the bytes' hex digits exchanged end for end; the closing G, above F,
        # puts a longer text before its own beginning
        neg = F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    elif isinstance(dt, T.BooleanType):
        neg = ~c
    elif isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        neg = F.bitwise_not(c)  # also reverses the smallest value, which has no negative
    elif isinstance(dt, T.DateType):
        neg = -F.unix_date(c)
    elif isinstance(dt, T.TimestampType):
        neg = -F.unix_micros(c)
    elif isinstance(dt, T.TimestampNTZType):
        # zone-free: microseconds from a fixed wall-clock epoch
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        neg = -F.timestamp_diff("MICROSECOND", epoch, c)
    else:
        neg = -c
    return [null_rank, neg]


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Order | str],
                method: str = "aggregate") -> DataFrame:
    """One whole row per ``partition_by`` group: the first by ``order_by``."""
    orders = _orders(order_by)
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    if method == "aggregate":
        keys: list[Column] = []
        for o in orders:
            k = _ascending_key(o, types[o.col], flip=False)
            if k is None:
                method = "window"
                break
            keys.extend(k)
    if method == "aggregate":
        packed = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], row.alias("row"))
        # a key's value is the group's own: who reads nothing but keys carries no rows
        own = {p: f"__p{i}" for i, p in enumerate(partition_by) if _exact(types.get(p))}
        return (df.groupBy(*[F.col(f"`{p}`").alias(f"__p{i}") for i, p in enumerate(partition_by)])
                .agg(F.min(packed).alias("__best"))
                .select(*[F.col(own.get(c, f"__best.row.`{c}`")).alias(c) for c in cols]))
    w = (Window.partitionBy(*[F.col(f"`{p}`") for p in partition_by])
         .orderBy(*[o.sort_col() for o in orders],
                  *[F.col(f"`{c}`").asc_nulls_first() for c in cols]))
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def latest_per_key(df: DataFrame, key: Sequence[str] | str, order_col: str,
                   nulls_first: bool = True, method: str = "aggregate") -> DataFrame:
    """Newest row per key (W1): ``order_col`` descending, NULLs first as in
    PostgreSQL's ``DESC`` unless told otherwise."""
    key = [key] if isinstance(key, str) else list(key)
    return deduplicate(df, key, [Order(order_col, desc=True, nulls_first=nulls_first)], method)


def first_per_key(df: DataFrame, key: Sequence[str] | str, order_col: str,
                  method: str = "aggregate") -> DataFrame:
    """First row per key by ``order_col`` ascending, NULLs last."""
    key = [key] if isinstance(key, str) else list(key)
    return deduplicate(df, key, [Order(order_col, desc=False, nulls_first=False)], method)
