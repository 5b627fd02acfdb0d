"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Columnar scan of one table; filters and projections applied later are
    pushed into it, and its splits follow ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` is a DataFrame."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.base, name)
        raise AttributeError(name)

    def register_views(self) -> None:
        for t in TABLES:
            read_table(self.spark, self.base, t).createOrReplaceTempView(t)


def scan_live(df: DataFrame, deleted_col: str = "deleted_at",
              required: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Soft-delete scan (S1) plus required-key filter (P5).

    Both predicates are plain ``IS NULL`` / ``IS NOT NULL`` so they reach the
    Parquet scan as pushed filters.
    """
    cond: Column = F.col(deleted_col).isNull()
    for k in required:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond)


def read_seed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Seed load (S2): header row, no inference pass; the columns of ``schema``
    are taken by name, whatever their order in the file."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    rows = spark.read.csv(path, header=True)
    return rows.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in fields])
