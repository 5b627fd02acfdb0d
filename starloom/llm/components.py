"""Connected components of an edge table by alternating large-star / small-star
rounds (Kiveris et al., 2014). Every round is two joins and two aggregations;
its edges are written to the shared folder in place of the last round's, so
lineage stays one round long. Nothing is collected but a count and a checksum of
each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored_instead


def _towards_least(edges: DataFrame) -> DataFrame:
    """Per node ``u`` its least neighbour ``m`` (itself included)."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v of one orderable
    type); ``root`` is the component's least node. Nodes without an edge to
    another node, and nulls, do not appear; no edges give no rows."""
    e, at = stored_instead(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                           "components", None)
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_towards_least(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = large.join(_towards_least(large), "u")
        e, at = stored_instead(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                               .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "components", at)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
