"""Finding tables by name pattern in the session catalog.

The catalog listing only reads metadata; the matched tables are then
unioned with ``union_relations`` (one lazy plan, no data on the driver).
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import UNION_SOURCE_COLUMN
from ..operators.reshape import union_relations
from .versions import children


def like_to_regex(pattern: str) -> re.Pattern:
    """SQL LIKE (``%``, ``_``, backslash escape) -> case-insensitive regex."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            out.append(re.escape(pattern[i + 1]))
            i += 2
            continue
        out.append(".*" if ch == "%" else "." if ch == "_" else re.escape(ch))
        i += 1
    return re.compile("^" + "".join(out) + "$", re.IGNORECASE)


def tables_by_pattern(spark: SparkSession, table_pattern: str, schema_pattern: str | None = None,
                      exclude: str = "") -> list[str]:
    """Names of tables/views whose name matches ``table_pattern`` (and whose
    database matches ``schema_pattern``), minus ``exclude``; sorted."""
    inc = like_to_regex(table_pattern)
    exc = like_to_regex(exclude) if exclude else None
    names = []
    dbs = [None]
    if schema_pattern is not None:
        sre = like_to_regex(schema_pattern)
        dbs = [d.name for d in spark.catalog.listDatabases() if sre.match(d.name)]
    for db in dbs:
        for t in (spark.catalog.listTables(db) if db else spark.catalog.listTables()):
            if inc.match(t.name) and not (exc and exc.match(t.name)):
                names.append(f"{db}.{t.name}" if db and not t.isTemporary else t.name)
    return sorted(set(names))


def tables_by_prefix(spark: SparkSession, prefix: str, schema: str | None = None,
                     exclude: str = "") -> list[str]:
    esc = prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return tables_by_pattern(spark, esc + "%", schema, exclude)


def union_by_pattern(spark: SparkSession, table_pattern: str, schema_pattern: str | None = None,
                     exclude: str = "", **union_kwargs) -> DataFrame:
    names = tables_by_pattern(spark, table_pattern, schema_pattern, exclude)
    if not names:
        raise ValueError(f"no tables match {table_pattern!r}")
    return union_relations([(n, spark.table(n)) for n in names], **union_kwargs)


#: Types that Parquet files of the types before them can be read as.
_READ_AS = [["tinyint", "smallint", "int", "bigint"], ["tinyint", "smallint", "int", "double"], ["float", "double"]]


def _readable(file: T.DataType, wanted: T.DataType) -> bool:
    a, b = file.simpleString(), wanted.simpleString()
    return a == b or any(a in w and b in w and w.index(a) < w.index(b) for w in _READ_AS)


def union_by_pattern_files(spark: SparkSession, folder: str, table_pattern: str, exclude: str = "",
                           source_column_name: str | None = UNION_SOURCE_COLUMN, where: str | Column | None = None) -> DataFrame:
    """UNION ALL of the tables (NAME.parquet, a file or a folder) under ``folder`` whose
    name matches, over the superset of their columns, by one scan of all their
    files; the source column is the table's name, taken from the file's path.

    Columns come in first-seen order (tables by name) with the first type seen; a
    column that a table lacks is NULL. Tables that have a column in a type which
    cannot be read as that one are read by a scan for each such list of types, and
    cast. ``where`` filters the result (and is pushed into the scan)."""
    inc, exc = like_to_regex(table_pattern), like_to_regex(exclude) if exclude else None
    names = [n.removesuffix(".parquet") for n in children(spark, folder) if n.endswith(".parquet")]
    names = [n for n in names if inc.match(n) and not (exc and exc.match(n))]
    if not names:
        raise ValueError(f"no tables match {table_pattern!r}")
    paths = {n: f"{folder.rstrip('/')}/{n}.parquet" for n in names}
    superset: dict[str, T.StructField] = {}
    groups: dict[tuple, list[str]] = {}
    for n, path in paths.items():  # footers only
        own = spark.read.parquet(path).schema.fields
        for f in own:
            superset.setdefault(f.name.lower(), f)
        odd = tuple((f.name, f.dataType.json()) for f in own if not _readable(f.dataType, superset[f.name.lower()].dataType))
        groups.setdefault(odd, []).append(path)
    table = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), r"/([^/]+)\.parquet(?:/.*)?$", 1)
    out = None
    for odd, own in groups.items():
        other = {name.lower(): T.StructType.fromJson({"type": "struct", "fields": [
            {"name": name, "type": json.loads(kind), "nullable": True, "metadata": {}}]}).fields[0] for name, kind in odd}
        rows = spark.read.schema(T.StructType([other.get(k, f) for k, f in superset.items()])).parquet(*own)
        cols = [F.col(f"`{other.get(k, f).name}`").cast(f.dataType).alias(f.name) for k, f in superset.items()]
        rows = rows.select(*([table.alias(source_column_name)] if source_column_name else []), *cols)
        out = rows if out is None else out.unionByName(rows)
    return out if where is None else out.filter(where)
