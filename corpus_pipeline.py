"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written and
read back before the next, so a lost executor repeats tasks of one stage only.
A stage's tables are removed once the next stage is written.
Stages keep every column of ``docs``; columns they add for themselves have free
names. Nulls: a null text counts as empty, so the quality stage drops it; rows
without an id are never merged away. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import free_name, id_bucket, scratch, shared_path, table
from starloom.llm.op01_quality import quality
from starloom.llm.op05_secrets import redacted
from starloom.llm.op07_simhash import keep_one_each
from starloom.llm.op08_packing import pack
from starloom.llm.op09_toxicity import HELD_OUT_MOD, HELD_OUT_REST, REJECT_AT, fit, toxicity
from starloom.sources.versions import delete

#: No single SQL statement expresses the classifier, the tokenizer or the components.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.7 or more. A null text scores as an empty
    one; without labels all texts score alike (0) and stay; repeated rows share
    their fate."""
    held = F.coalesce(id_bucket("doc_id", HELD_OUT_MOD) == HELD_OUT_REST, F.lit(False))
    model = fit(docs, table(spark, sf_dir, "labels"), held_out=held)
    mark = free_name(docs, "toxicity")
    return docs.withColumn(mark, toxicity(F.col("text"), model)).where(F.col(mark) < REJECT_AT).drop(mark)


def drop_repetitive(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject: null and short texts
    go, repeated rows share their fate."""
    mark = free_name(docs, "quality")
    return docs.withColumn(mark, quality(F.col("text"))).where(F.col(mark)["kept"]).drop(mark)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each near-duplicate component. Of several
    rows with that id one stays, also if they differ in other columns only; rows
    without an id stay."""
    return keep_one_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts replaced by a mark; ``n_chars``, if there is one, follows. A
    null text stays null; every row stays."""
    out = docs.withColumn("text", redacted(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two lengths, each a sequence. A null or empty text
    is one end token; repeated rows are packed each."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_repetitive),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the last stage's."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
