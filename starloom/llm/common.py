"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import starloom
from starloom.session import ensure_checkpoint_dir
from starloom.sources.versions import delete

PIECE_CHARS = 1 << 20
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code (once per application), so that
    Python tasks can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    top = os.path.dirname(os.path.abspath(starloom.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="starloom-code-"), "starloom_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("starloom", os.path.relpath(path, top)))
    sc.addPyFile(target)


def arrow_udf_of(fn, kind):
    """A pandas UDF whose module the executors can import."""
    ship(SparkSession.active())
    return F.pandas_udf(fn, kind)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the files of every table that is ``stored`` meanwhile: for
    work whose result is written elsewhere before the end."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            delete(spark, path)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends in
    files that outlive any executor."""
    return stored_instead(df, tag, None)[0]


def stored_instead(df: DataFrame, tag: str, before: str | None) -> tuple[DataFrame, str]:
    """``stored``, with its path; the table at the path ``before``, which ``df`` was
    made from, is removed once ``df`` is written."""
    path = shared_path(df.sparkSession, tag)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.parquet(path)
    if before:
        delete(df.sparkSession, before)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def id_bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(modulus)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def slabs(texts: Iterable[str | None], chars: int = PIECE_CHARS) -> Iterator[list[str]]:
    """Consecutive runs of texts (null: empty) of about ``chars`` characters, so
    that per-character arrays stay small whatever the batch holds."""
    out, size = [], 0
    for t in texts:
        t = t or ""
        if out and size + len(t) > chars:
            yield out
            out, size = [], 0
        out.append(t)
        size += len(t)
    if out:
        yield out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of ``texts`` in a row, and the offsets of each text."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    flat = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(flat, np.uint32), np.concatenate([[0], ends])
