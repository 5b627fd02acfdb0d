"""Checks from stored partial states (Q2, Q8, Q10, Q11, Q16): after an upsert only
the parts that changed are read.

A part (month) of a versioned table is a folder of one run, never changed
afterwards, so its state can be kept: row count, and for each column the
non-null count, the least and the greatest value (two distinct values, if there are
two), and for each key the number of its rows. States of all parts merge by sum,
min and max. A refresh computes the states of parts whose run is new and stores
them in a folder of their own; a folder counts once it is complete.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions
from .quality import _date_add

#: Folders of states after which they are written anew as one.
STATE_FOLDERS = 16


@dataclass(frozen=True)
class StateCheck:
    """A check of one table: ``name``, the columns whose states it needs, the count of
    its failures from the merged state, or the key that is to be unique."""

    name: str
    columns: tuple[str, ...] = ()
    failures: object = None
    key: tuple[str, ...] = ()


def _s(column: str, what: str) -> Column:
    return F.col(f"`{column}`")[what]


def at_least_one(column: str) -> StateCheck:
    return StateCheck("at_least_one", (column,), lambda: F.when(_s(column, "non_null") == 0, 1).otherwise(0))


def not_constant(column: str) -> StateCheck:
    return StateCheck("not_constant", (column,), lambda: F.when(_s(column, "low") == _s(column, "high"), 1).otherwise(0))


def not_null_proportion(column: str, at_least: float, at_most: float = 1.0) -> StateCheck:
    def failures() -> Column:
        share = _s(column, "non_null").cast("double") / F.nullif(F.col("n"), F.lit(0)).cast("double")
        return F.when((share < at_least) | (share > at_most), 1).otherwise(0)

    return StateCheck("not_null_proportion", (column,), failures)


def recency(column: str, datepart: str, interval: int, now) -> StateCheck:
    def failures() -> Column:
        return F.when(_s(column, "high") < _date_add(F.lit(str(now)).cast("timestamp_ntz"), datepart, -interval), 1).otherwise(0)

    return StateCheck("recency", (column,), failures)


def unique_combination(*columns: str) -> StateCheck:
    return StateCheck("unique_combination_of_columns", key=columns)


def _part_of(version: versions.Version) -> Column:
    """The part folder of a row."""
    names = [c for c, _ in version.partition_by]
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(versions.NULL_PART))) for c in names])


def _stored(spark: SparkSession, folder: str) -> list[str]:
    return [f"{folder}/{n}" for n in versions.children(spark, folder) if versions.exists(spark, f"{folder}/{n}/_SUCCESS")]


def _owners(spark: SparkSession, folder: str, wanted: set[tuple[str, str]]) -> dict[str, list[tuple[str, str]]]:
    """The complete folders of states, and which of the wanted (part, run) are read
    from each: one folder for each, also if a rewrite broke off before its end."""
    left, out = set(wanted), {}
    for p in _stored(spark, folder):
        own = {tuple(r) for r in spark.read.parquet(p).select("part", "run").distinct().collect()} & left  # parts, not rows
        out[p] = sorted(own)
        left -= own
    return out


def _refreshed(spark: SparkSession, path: str, version: versions.Version, kind: str, compute) -> tuple[DataFrame, list[str]]:
    """The states of all parts of the version, and the parts that had to be computed."""
    folder = f"{path.rstrip('/')}__states/{kind}"
    wanted = set(version.parts.items())

    def of(pairs: list[tuple[str, str]]) -> DataFrame:
        return spark.createDataFrame(pairs, "part string, run string")

    def states() -> DataFrame:
        found = [spark.read.parquet(p).join(of(own), ["part", "run"], "left_semi") for p, own in _owners(spark, folder, wanted).items()]
        return reduce(DataFrame.unionByName, found)

    before = _owners(spark, folder, wanted)
    missing = sorted(wanted - {x for own in before.values() for x in own})
    if missing or not before:
        rows = versions.read_table(spark, path, version, [p for p, _ in missing]).withColumn("part", _part_of(version))
        compute(rows).join(of(missing), "part").write.parquet(f"{folder}/{uuid.uuid4().hex}")
    if len(before) >= STATE_FOLDERS:
        old = _stored(spark, folder)
        states().write.parquet(f"{folder}/{uuid.uuid4().hex}")
        for p in old:  # states of parts that are gone go with them
            versions.delete(spark, p)
    return states(), [p for p, _ in missing]


def run_state_checks(spark: SparkSession, path: str, checks: Sequence[StateCheck]) -> tuple[DataFrame, list[str]]:
    """One summary row per check (check_index, check_name, failures) of the newest
    version of the partitioned table at ``path``, as ``run_suite`` over the whole
    table gives it, and the parts that were read for it."""
    version = versions.current(spark, path)
    columns = sorted({c for ch in checks for c in ch.columns})
    parts, read = [], []
    if columns:
        def column_states(rows: DataFrame) -> DataFrame:
            return rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), *[F.struct(
                F.count(F.col(f"`{c}`")).alias("non_null"), F.min(f"`{c}`").alias("low"), F.max(f"`{c}`").alias("high")).alias(c) for c in columns])

        states, read = _refreshed(spark, path, version, "columns-" + "-".join(columns), column_states)
        merged = states.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.struct(
            F.coalesce(F.sum(_s(c, "non_null")), F.lit(0)).alias("non_null"), F.min(_s(c, "low")).alias("low"), F.max(_s(c, "high")).alias("high")).alias(c)
            for c in columns])
        parts.append(merged.select(F.inline(F.array(*[F.struct(F.lit(i).alias("check_index"), ch.failures().cast("long").alias("failures"))
                                                      for i, ch in enumerate(checks) if ch.columns]))))
    for i, ch in enumerate(checks):
        if ch.key:
            key = [F.col(f"`{c}`") for c in ch.key]
            states, own = _refreshed(spark, path, version, "keys-" + "-".join(ch.key),
                                     lambda rows, key=key: rows.groupBy("part", *key).agg(F.count(F.lit(1)).alias("__n")))
            read = sorted({*read, *own})
            again = states.groupBy(*key).agg(F.sum("__n").alias("n")).where("n > 1")
            parts.append(again.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(i).alias("check_index"), "failures"))
    names = F.get(F.array(*[F.lit(ch.name) for ch in checks]), F.col("check_index"))
    return reduce(DataFrame.unionByName, parts).select("check_index", names.alias("check_name"), "failures"), read
