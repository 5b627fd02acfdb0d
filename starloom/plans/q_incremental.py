"""Incremental fact loads as registered queries.

Scenario: the target holds the fact as loaded up to a cut-off date, and its
last weeks are stale (some values changed since). The incremental run
recomputes the 30-day look-back window and upserts it by the unique key.
For ``fct_game_results`` the result must equal a full refresh, which is
what the oracle computes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.sinks import lookback_start, merge_by_key
from .layers import Warehouse
from .oracle_models import with_models
from .registry import query
from ..session import ensure_checkpoint_dir
from ..sources.sinks import partition_month, read_layer, upsert_partitions, write_layer
from ..sources.tables import Tables

CUTOFF = "1998-01-01"


@query("incremental_upsert", with_models("SELECT * FROM fct_game_results"))
def q_incremental_upsert(spark, d):
    w = Warehouse(spark, d)
    full = w.fct_game_results
    target = full.filter(F.col("game_date") < F.lit(CUTOFF).cast("date"))
    # stale copies of the last weeks before the cut-off
    since = lookback_start(target, "game_date", 30)
    target = target.withColumn(
        "home_points", F.when(F.col("game_date") >= since.scalar(), F.col("home_points") - 1)
        .otherwise(F.col("home_points")))
    delta = w.fact("fct_game_results", since=since)
    return merge_by_key(target, delta, "game_key")


@query("schema_sync", with_models(f"""
, s AS (SELECT max(game_date) - INTERVAL 30 DAY AS since FROM fct_team_game_stats
           WHERE game_date < DATE '{CUTOFF}')
SELECT t.* REPLACE (CAST(NULL AS DOUBLE) AS turnover_rate) FROM fct_team_game_stats t, s
WHERE t.game_date < DATE '{CUTOFF}'
  AND t.team_game_key NOT IN (SELECT team_game_key FROM fct_team_game_stats f, s WHERE f.game_date >= s.since)
UNION ALL
SELECT f.* FROM fct_team_game_stats f, s WHERE f.game_date >= s.since
"""))
def q_schema_sync(spark, d):
    w = Warehouse(spark, d)
    full = w.stored(w.fct_team_game_stats, "fct_team_game_stats")
    # the stored table predates the turnover_rate column and still has a
    # column the model no longer produces
    target = (full.filter(F.col("game_date") < F.lit(CUTOFF).cast("date"))
              .drop("turnover_rate").withColumn("legacy_flag", F.lit(True)))
    since = lookback_start(target, "game_date", 30)
    # the delta is computed once, though the merge reads its keys and its rows
    delta = w.stored(w.fact("fct_team_game_stats", since=since), "delta")
    return merge_by_key(target, delta, "team_game_key")


def _dated_orders(spark, d):
    """Orders with a date; every 1-URGENT order has none."""
    return Tables(spark, d).orders.select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("amount"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate").cast("date")).alias("order_date"))


def _sink_run(spark, target, delta):
    """The real sink: write the target table, upsert the delta, read it back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sink-{uuid.uuid4().hex}"
    write_layer(target.withColumn("_month", partition_month("order_date")), path, ["_month"], key=["o_orderkey"])
    upsert_partitions(spark, path, delta, "o_orderkey", "order_date")
    return read_layer(spark, path).select(*delta.columns)


_DATED = """
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS amount,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) END AS order_date, o_orderstatus
FROM orders"""


@query("incremental_sink", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN amount + 1 ELSE amount END AS amount,
       CASE WHEN o_orderstatus = 'F' THEN coalesce(order_date, DATE '1995-06-17') ELSE order_date END AS order_date
FROM ({_DATED})""")
def q_incremental_sink(spark, d):
    """Upsert through the partition sink: undated rows stay, open orders keep
    their values, finished ones change and move out of the NULL partition."""
    target = _dated_orders(spark, d)
    done = Tables(spark, d).orders.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    delta = target.join(done, "o_orderkey", "left_semi").select(
        "o_orderkey", (F.col("amount") + 1).alias("amount"),
        F.coalesce("order_date", F.lit("1995-06-17").cast("date")).alias("order_date"))
    return _sink_run(spark, target, delta)


@query("schema_sync_sink", f"""
SELECT o_orderkey, amount, order_date, CASE WHEN o_orderstatus = 'F' THEN 'done' END AS note FROM ({_DATED})""")
def q_schema_sync_sink(spark, d):
    """The sink takes the delta's columns: one more, one less."""
    rows = _dated_orders(spark, d)
    done = Tables(spark, d).orders.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    delta = rows.join(done, "o_orderkey", "left_semi").withColumn("note", F.lit("done"))
    return _sink_run(spark, rows.withColumn("legacy", F.lit(1)), delta)
