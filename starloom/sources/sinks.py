"""Writing layers: full refresh, keyed incremental upsert, schema sync,
check-failure storage (S4-S6, I1).

No transactional table format is assumed: a layer is a folder of Parquet files
with numbered versions (``versions``), read with ``read_layer``. Every write makes
new files and then one version file, so a write that breaks off, at any point,
leaves the table as it was; it is run again, and nothing has to be recovered.

A fact is partitioned by month of its date column. An upsert

1. stores the delta once (this cuts its lineage),
2. finds the *affected* months: those of the delta, and those that hold a delta
   key already (a key may have moved to another date). The table's key locator,
   kept beside it, says which: hashes of all keys with their months, in buckets
   by hash; only the buckets of the delta's keys are read,
3. writes ``(rows of the affected months minus delta keys) + delta`` to a new run
   and the delta's new or moved keys to the locator, and
4. commits a version in which the affected months come from that run.

If the delta has other columns (``sync_all_columns``), the version says so: files
of untouched months stay and are read by their own column list. Only a type that
cannot be cast without failing rewrites the whole table.

Every step is a Spark job whose tasks commit atomically, so a lost executor only
re-runs its tasks. Of two runs on one table the second to finish fails. Rows
without a date live in the NULL partition and are upserted alike.
"""

from __future__ import annotations

from dataclasses import replace
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions
from .versions import NULL_PART, Version, read_table

#: Buckets of a key locator: the most files that a small delta reads there.
LOCATOR_BUCKETS = 64
#: Runs after which a key locator is written anew as one.
LOCATOR_RUNS = 32


def partition_month(date_col: str) -> Column:
    return F.date_format(F.col(date_col), "yyyy-MM")


def layer_exists(spark: SparkSession, path: str) -> bool:
    """Whether a write of the layer was ever finished (with versions, or plainly)."""
    return versions.current(spark, path) is not None or versions.exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version of a layer."""
    return read_table(spark, path)


def _write_run(df: DataFrame, path: str, partition_by: Sequence[str], sort_within: Sequence[str]) -> tuple[str, dict[str, str]]:
    """New files of ``df``: the run and its parts."""
    spark, run = df.sparkSession, versions.new_run(df.sparkSession)
    out = df
    if partition_by:
        # REBALANCE: AQE groups rows of a partition value into right-sized
        # tasks -- small months are coalesced (few files), a huge month is
        # split over several tasks (no single task writes it all)
        out = out.hint("rebalance", *partition_by)
    out = out.sortWithinPartitions(*sort_within) if sort_within else out
    w = out.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(versions.run_path(path, run))
    return run, dict.fromkeys(versions.written_parts(spark, path, run, len(partition_by)), run)


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                key: Sequence[str] = ()) -> None:
    """Full-refresh sink (S4): ``df`` becomes the table's next version. Until its
    last step readers see the old one. Sorting within partitions (not a global
    sort) gives clustered files without a range shuffle. With ``key`` the table
    gets a key locator (its first partition column is what keys are located in)."""
    spark = df.sparkSession
    run, parts = _write_run(df, path, partition_by, sort_within)
    kinds = dict(versions.typed(df, []))
    by = [(c, kinds[c]) for c in partition_by]
    columns = versions.typed(df, list(partition_by))
    locator = {}
    if key:
        fresh = Version(0, by, [(n, t, 0) for n, t in columns], parts, {run: {"version": 0, "columns": [list(c) for c in columns]}})
        locator = _locate(spark, path, {}, _pairs(read_table(spark, path, fresh), list(key), partition_by[0]), list(key))
    versions.commit(spark, path, versions.current(spark, path), by, columns, parts, run, locator)


def with_load_time(df: DataFrame, name: str = "loaded_at") -> DataFrame:
    """Load timestamp (F23), added at write time only."""
    return df.withColumn(name, F.current_timestamp())


def sync_schema(target: DataFrame, delta: DataFrame) -> DataFrame:
    """``sync_all_columns`` (S5): the target takes the delta's columns --
    new columns appear as NULL, vanished columns are dropped, and changed
    types are cast to the delta's type."""
    types = {f.name: f.dataType for f in delta.schema.fields}
    have = set(target.columns)
    cols = [(F.col(f"`{c}`") if c in have else F.lit(None)).cast(types[c]).alias(c)
            for c in delta.columns]
    return target.select(*cols)


def merge_by_key(target: DataFrame, delta: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Keyed upsert (I1): target rows whose key appears in the delta are
    replaced by the delta rows (delete + insert). The anti-join reads only
    the delta's distinct keys; the optimizer broadcasts them when they are
    measured small, else it shuffles both sides on the key."""
    keys = [key] if isinstance(key, str) else list(key)
    target = sync_schema(target, delta)
    delta_keys = delta.select(*keys).distinct()
    return target.join(delta_keys, keys, "left_anti").unionByName(delta)


def lookback_start(target: DataFrame, date_col: str, days: int) -> DataFrame:
    """One-row frame ``since`` = max(date) - days."""
    return target.agg((F.max(F.col(date_col).cast("date")) - F.expr(f"INTERVAL {days} DAYS")).alias("since"))


def _last_month(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """The rows of the last month, which holds the greatest date: months sort as text."""
    dated = [p for p in version.parts if not p.endswith(NULL_PART)]
    return read_table(spark, path, version, [max(dated)] if dated else None)


def incremental_refresh(spark: SparkSession, path: str,
                        build: Callable[[DataFrame | None], DataFrame], key: Sequence[str] | str,
                        date_col: str = "game_date", lookback_days: int = 30,
                        part_col: str = "_month", full_refresh: bool = False) -> str:
    """Run one incremental (or full) load of the table at ``path``.

    ``build(since)`` returns the rows to (re)load: all rows when ``since``
    is None, else those in the look-back window. The load is full if no load of the
    table was ever finished, or with ``full_refresh``. Returns "full" or
    "incremental".
    """
    keys = [key] if isinstance(key, str) else list(key)
    version = _adopted(spark, path, keys, part_col)
    if version is None or full_refresh:
        write_layer(build(None).withColumn(part_col, partition_month(date_col)), path, [part_col], key=keys)
        return "full"
    since = lookback_start(_last_month(spark, path, version), date_col, lookback_days)
    upsert_partitions(spark, path, build(since), keys, date_col, part_col)
    return "incremental"


def _adopted(spark: SparkSession, path: str, keys: list[str], part_col: str) -> Version | None:
    """The table's version; a finished plain Parquet folder becomes version 1. None
    if nothing was ever finished there."""
    version = versions.current(spark, path)
    if version is None and versions.exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        plain = spark.read.parquet(path)
        write_layer(plain.withColumn(part_col, F.col(part_col).cast("string")), path, [part_col], key=keys)
        for name in versions.children(spark, path):  # the plain files, now that the version names its own
            if name not in ("data", "located", "versions"):
                versions.delete(spark, f"{path.rstrip('/')}/{name}")
        version = versions.current(spark, path)
    return version


# key locator -------------------------------------------------------------------

def _bucket(key_hash: Column) -> Column:
    return F.pmod(key_hash, F.lit(LOCATOR_BUCKETS)).cast("int")


def _pairs(rows: DataFrame, keys: list[str], part_col: str) -> DataFrame:
    """(key hash, partition value) of each row."""
    return rows.select(F.xxhash64(*keys).alias("key_hash"), F.col(part_col).cast("string").alias("part"))


def _located(spark: SparkSession, path: str, locator: dict, buckets: list[int] | None = None) -> DataFrame:
    """The locator's pairs, or those of some buckets: other folders are not read."""
    schema = T.StructType.fromDDL(f"key_hash long, part string, __bucket int, {versions.RUN} string")
    runs = [versions.run_path(path, r, "located") for r in locator.get("runs", [])]
    paths = runs if buckets is None else [
        f"{r}/__bucket={b}" for r in runs for b in buckets if f"__bucket={b}" in set(versions.children(spark, r))]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path.rstrip('/')}/located").parquet(*paths)


def _locate(spark: SparkSession, path: str, locator: dict, pairs: DataFrame, keys: list[str]) -> dict:
    """The locator with one more run that holds ``pairs``."""
    run = versions.new_run(spark)
    (pairs.withColumn("__bucket", _bucket(F.col("key_hash"))).hint("rebalance", "__bucket").sortWithinPartitions("__bucket", "key_hash")
     .write.partitionBy("__bucket").parquet(versions.run_path(path, run, "located")))
    return {"keys": keys, "runs": [*locator.get("runs", []), run]}


def upsert_partitions(spark: SparkSession, path: str, delta: DataFrame, key: Sequence[str] | str,
                      date_col: str = "game_date", part_col: str = "_month",
                      version_col: str | None = None) -> None:
    """Upsert ``delta`` by key into the month-partitioned table at ``path``,
    rewriting only the affected months (steps 1-4 above). Idempotent: applying
    the same delta twice leaves the same rows. With ``version_col`` a delta row
    older than the stored row of its key is left out."""
    keys = [key] if isinstance(key, str) else list(key)
    old = _adopted(spark, path, keys, part_col)
    delta = delta.withColumn(part_col, partition_month(date_col))
    if old is None:
        write_layer(delta, path, [part_col], key=keys)
        return
    # the delta is computed once and read back by the steps below: this cuts
    # its lineage and keeps the merge plan small
    staged = versions.run_path(path, versions.new_run(spark), "staging")
    delta.write.parquet(staged)
    delta = spark.read.schema(delta.schema).parquet(staged)

    known = old.locator if old.locator.get("keys") == keys else _locate(
        spark, path, {}, _pairs(read_table(spark, path, old), keys, part_col), keys)
    pairs = _pairs(delta, keys, part_col).distinct()
    buckets = [r[0] for r in pairs.select(_bucket(F.col("key_hash"))).distinct().collect()]  # at most LOCATOR_BUCKETS
    here = _located(spark, path, known, buckets).select("key_hash", "part")
    places = pairs.select("part").union(here.join(pairs.select("key_hash").distinct(), "key_hash", "left_semi").select("part"))
    months = [r[0] for r in places.distinct().collect()]  # partition values that the delta touches
    touched = {f"{part_col}={NULL_PART if m is None else m}" for m in months}

    columns = versions.typed(delta, [part_col])
    whole = not _grown_only(old, columns)
    scope = read_table(spark, path, old, None if whole else sorted(touched))
    if version_col is not None and version_col in scope.columns:
        newest = (scope.select(*keys, F.col(version_col).alias("__stored")).join(delta.select(*keys).distinct(), keys, "left_semi")
                  .groupBy(*keys).agg(F.max("__stored").alias("__stored")))
        delta = (delta.join(newest, keys, "left")
                 .where(F.col("__stored").isNull() | (F.col(version_col) >= F.col("__stored"))).select(*delta.columns))
        pairs = _pairs(delta, keys, part_col).distinct()
    run, parts = _write_run(merge_by_key(scope, delta, keys), path, [part_col], ())
    new_places = pairs.join(here, (pairs["key_hash"] == here["key_hash"]) & pairs["part"].eqNullSafe(here["part"]), "left_anti")
    if len(known["runs"]) < LOCATOR_RUNS:
        locator = _locate(spark, path, known, new_places, keys)
    else:
        locator = _locate(spark, path, {}, _located(spark, path, known).select("key_hash", "part").union(pairs).distinct(), keys)
    kept = {} if whole else {p: r for p, r in old.parts.items() if p not in touched}
    versions.commit(spark, path, old, old.partition_by, columns, kept | parts, run, locator)


#: Types whose every value has its place in the types after them.
_WIDER = [["byte", "short", "integer", "long"], ["byte", "short", "integer", "float", "double"], ["float", "double"], ["date", "timestamp_ntz"], ["date", "timestamp"]]


def _grown_only(old: Version, columns: list[tuple[str, str]]) -> bool:
    """Whether files of the old columns can be read as the new ones: every type that
    changed became a wider one, or text."""
    types = {n: t.strip('"') for n, t, _ in old.columns}

    def grows(a: str, b: str) -> bool:
        return a == b or (b == "string" and not a.startswith("{")) or any(
            a in w and b in w and w.index(a) < w.index(b) for w in _WIDER)

    return all(grows(types[n], t.strip('"')) for n, t in columns if n in types)


def write_checked(df: DataFrame, path: str, checks, **how) -> DataFrame:
    """Write ``df`` as a layer and check it on the way: the row checks of ``df`` are
    counted while its rows are written (no scan of their own), the others after it.
    The summary is that of ``run_suite`` (check_index, check_name, failures, status).

    Rows of a task that ran twice would be counted twice; so the rows are counted
    too, and if that is not what the table holds, the checks run on the table."""
    from ..operators.quality import run_suite
    spark = df.sparkSession
    on_rows = [i for i, ch in enumerate(checks) if ch.relation is df and ch.fails is not None and ch.fail_calc is None]
    watch = Observation()
    watched = df.observe(watch, F.count(F.lit(1)).alias("rows"), *[F.count_if(checks[i].fails).alias(f"c{i}") for i in on_rows])
    write_layer(watched, path, **how)
    seen, stored = watch.get, read_layer(spark, path)
    counts = [seen.get(f"c{i}", 0) for i in on_rows]
    if seen["rows"] != stored.count():
        counts = list(stored.agg(*[F.count_if(checks[i].fails) for i in on_rows]).first()) if on_rows else []
    told = dict(zip(on_rows, counts))
    done = [replace(ch, failures=spark.range(1).select(F.lit(told[i]).cast("long").alias("n")), fail_calc=F.max("n"), relation=None, fails=None)
            if i in told else ch for i, ch in enumerate(checks)]
    return run_suite(done)


def write_bucketed(df: DataFrame, table: str, path: str, by: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` as a catalog table in hash buckets of ``by``: joins of tables with
    equal buckets on (at least) these columns need no exchange. One file a bucket."""
    spark = df.sparkSession
    (df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).option("path", path).mode("overwrite").saveAsTable(table))
    return spark.table(table)


def store_failures(checks, base_path: str) -> list:
    """Failure sink (S6): each check's failing rows to its own directory.
    Returns the checks reading those rows, so that counting them computes no
    check again."""
    out = []
    for i, ch in enumerate(checks):
        path = f"{base_path.rstrip('/')}/{i:03d}_{ch.name}"
        ch.failures.write.mode("overwrite").parquet(path)
        stored = ch.failures.sparkSession.read.schema(ch.failures.schema).parquet(path)
        out.append(replace(ch, failures=stored, relation=None, fails=None))
    return out
