"""Tables as numbered versions: a refresh that breaks off leaves the old table.

A table's folder holds

    data/__run=RUN/[PART=VALUE/...]   files of one write, never changed afterwards
    located/__run=RUN/__bucket=B/     key hashes and their partitions (see sinks)
    versions/NUMBER.json              one small file for each version of the table

A version file says which parts (folders) of which runs make up the table, its
columns, and the version that each column exists since. It is written last, and
its appearance is the whole commit: it is renamed into place, so that it is
either there in full or not at all. Readers take the newest one. Data of a run
without a version are never read; the next successful write removes them, and
what only versions older than ``KEPT_VERSIONS`` name.

A file of an older column list is read by its own list: columns that the table
gained since are NULL, those that it lost are not read, and types that grew are
cast. Only the number of files is unbounded; a version file grows with the
number of partition values (months), not with the data.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT_VERSIONS = 2
RUN = "__run"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentWrite(RuntimeError):
    """Another write of the table committed first."""


@dataclass
class Version:
    number: int
    #: name and type (Spark's JSON) of the partition columns
    partition_by: list[tuple[str, str]]
    #: name, type and the version that the column exists since
    columns: list[tuple[str, str, int]]
    #: folder below the run ("" for an unpartitioned table) -> run
    parts: dict[str, str]
    #: run -> its version and its columns (name, type)
    runs: dict[str, dict] = field(default_factory=dict)
    #: key columns and runs of the key locator, if the table has one
    locator: dict = field(default_factory=dict)


def _struct(columns: list) -> T.StructType:
    """The schema of columns (name, type, ...)."""
    return T.StructType.fromJson({"type": "struct", "fields": [
        {"name": c[0], "type": json.loads(c[1]), "nullable": True, "metadata": {}} for c in columns]})


# file system -----------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it does not exist)."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path`` in one step; False if there is one already."""
    fs, p = _fs(spark, path)
    draft = _fs(spark, f"{path}.{uuid.uuid4().hex}.draft")[1]
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(draft, p):
        fs.delete(draft, False)
        return False
    return True


# versions --------------------------------------------------------------------

def _root(path: str) -> str:
    return path.rstrip("/")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = children(spark, f"{_root(path)}/versions")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, path: str, number: int) -> Version:
    raw = json.loads(_read_text(spark, f"{_root(path)}/versions/{number:010d}.json"))
    return Version(**raw | {k: [tuple(c) for c in raw[k]] for k in ("columns", "partition_by")})


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version, None if no write of the table has ever been finished."""
    numbers = _numbers(spark, path)
    return load(spark, path, numbers[-1]) if numbers else None


def new_run(spark: SparkSession) -> str:
    return uuid.uuid4().hex


def run_path(path: str, run: str, folder: str = "data") -> str:
    return f"{_root(path)}/{folder}/{RUN}={run}"


def written_parts(spark: SparkSession, path: str, run: str, depth: int) -> list[str]:
    """The part folders of a run, ``depth`` levels of PART=VALUE below it."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}" if f else n for f in found for n in children(spark, f"{run_path(path, run)}/{f}".rstrip("/")) if "=" in n]
    return found


def typed(df: DataFrame, without: list[str]) -> list[tuple[str, str]]:
    """Name and type of the columns that are stored in the files."""
    return [(f.name, json.dumps(f.dataType.jsonValue())) for f in df.schema.fields if f.name not in without]


def commit(spark: SparkSession, path: str, old: Version | None, partition_by: list[tuple[str, str]], columns: list[tuple[str, str]],
           parts: dict[str, str], run: str | None, locator: dict | None = None) -> Version:
    """Make the next version the table: ``parts`` of the runs so far and of ``run``."""
    number = old.number + 1 if old else 1
    since = {n: s for n, _, s in old.columns} if old else {}
    runs = dict(old.runs) if old else {}
    if run is not None:
        runs[run] = {"version": number, "columns": [list(c) for c in columns]}
    live = set(parts.values()) | ({run} if run is not None else set())
    new = Version(number, list(partition_by), [(n, t, since.get(n, number)) for n, t in columns], parts,
                  {r: v for r, v in runs.items() if r in live}, locator or {})
    if not _write_new(spark, f"{_root(path)}/versions/{number:010d}.json", json.dumps(asdict(new))):
        raise ConcurrentWrite(f"version {number} of {path} was written by another run")
    _clean(spark, path)
    return new


def _clean(spark: SparkSession, path: str) -> None:
    """Remove what no kept version names: old versions and the files of broken writes."""
    numbers = _numbers(spark, path)
    kept = [load(spark, path, n) for n in numbers[-KEPT_VERSIONS:]]
    for n in numbers[:-KEPT_VERSIONS]:
        delete(spark, f"{_root(path)}/versions/{n:010d}.json")
    used = {"data": {r for v in kept for r in v.runs}, "located": {r for v in kept for r in v.locator.get("runs", [])}, "staging": set()}
    for folder, runs in used.items():
        for name in children(spark, f"{_root(path)}/{folder}"):
            if name.removeprefix(f"{RUN}=") not in runs:
                delete(spark, f"{_root(path)}/{folder}/{name}")
    named: dict[str, set[str]] = {}
    for v in kept:
        for part, run in v.parts.items():
            named.setdefault(part, set()).add(run)
    depth = len(kept[-1].partition_by)
    for run in used["data"] if depth else ():  # parts of a live run that later versions replaced
        for part in written_parts(spark, path, run, depth):
            if run not in named.get(part, ()):
                delete(spark, f"{run_path(path, run)}/{part}")


def read_table(spark: SparkSession, path: str, version: Version | None = None, parts: list[str] | None = None) -> DataFrame:
    """The table at ``path`` in its newest (or the given) version; with ``parts``
    only these part folders. One scan for each column list that its files have.
    A folder that holds no versions is read as plain Parquet."""
    version = version or current(spark, path)
    if version is None:
        return spark.read.parquet(path)
    schema, part_types = _struct(version.columns), _struct(version.partition_by).fields
    groups: dict[str, list[str]] = {}
    for folder, run in version.parts.items():
        if parts is None or folder in parts:
            own = version.runs[run]
            usable = [(n, t) for n, t in own["columns"] if any(n == c and since <= own["version"] for c, _, since in version.columns)]
            groups.setdefault(json.dumps([own["columns"], usable]), []).append(f"{run_path(path, run)}/{folder}".rstrip("/"))
    out = None
    for key, folders in sorted(groups.items()):
        stored, usable = json.loads(key)
        df = (spark.read.schema(T.StructType([*_struct(stored).fields, *part_types, T.StructField(RUN, T.StringType())]))
              .option("basePath", f"{_root(path)}/data").parquet(*folders))
        have = {n for n, _ in usable}
        cols = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        df = df.select(*cols, *[F.col(f"`{c.name}`") for c in part_types])
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], T.StructType([*schema.fields, *part_types]))
    return out
