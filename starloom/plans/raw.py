"""Raw box-score source tables derived from the test tables.

The models of the star schema read six raw tables and three seed mappings.
They are derived here from ``orders`` (one game per order), ``lineitem``
grouped by (order, part) (one player line per group), ``nation`` (teams)
and ``region`` (arena cities), with integer arithmetic only, so Spark and
DuckDB produce identical inputs. Each column is one SQL expression used
both by Spark (``selectExpr``) and by the DuckDB oracle (as a CTE), so the
two engines read the same raw rows; the models themselves are written
separately in each engine.

Work grows with the inputs: games = orders, player lines = lineitem
groups; the per-side expansion is a 2-element ``explode`` (no join).
Both tables are dealt out by game while their rows are narrow. Every model joins
by game, so the wide rows of the layers are not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Tables

_SIDE_TEAM = ("CASE WHEN s = 0 THEN (CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE 'T' END) "
              "|| CAST(o_custkey % 25 AS STRING) "
              "ELSE 'T' || CAST((o_custkey + 1 + o_orderkey % 24) % 25 AS STRING) END")
_PLAYER_TEAM = ("CASE WHEN l_partkey % 2 = 0 THEN (CASE WHEN l_orderkey % 3 = 0 THEN 'X' ELSE 'T' END) "
                "|| CAST(o_custkey % 25 AS STRING) "
                "ELSE 'T' || CAST((o_custkey + 1 + l_orderkey % 24) % 25 AS STRING) END")
_PLAYER_MP = ("CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN '' "
              "WHEN l_partkey % 9 = 0 THEN CAST(5 + (qty * 7) % 40 AS STRING) "
              "ELSE CAST(5 + (qty * 7) % 40 AS STRING) || ':' "
              "|| lpad(CAST((l_partkey * 13) % 60 AS STRING), 2, '0') END")


def _pct(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / ({den}) END"


GAMES = [
    ("game_id", "'G' || CAST(o_orderkey AS STRING)"),
    ("date", "o_orderdate"),
    ("home_team", "h.n_name"),
    ("visitor_team", "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE v.n_name END"),
    ("is_playoff", "o_orderpriority = '1-URGENT'"),
    ("start_time_et", "CAST(1 + o_orderkey % 12 AS STRING) || ':' "
                      "|| CASE WHEN o_orderkey % 2 = 0 THEN '00' ELSE '30' END "
                      "|| CASE WHEN o_orderkey % 7 = 0 THEN 'a' ELSE 'p' END"),
    ("arena", "'Arena ' || CAST(o_custkey % 25 AS STRING)"),
    ("home_pts", "CAST(80 + (o_orderkey * 7) % 50 AS INT)"),
    ("visitor_pts", "CAST(80 + (o_orderkey * 8) % 50 AS INT)"),
    ("game_duration", "CAST(120 + o_orderkey % 60 AS INT)"),
    ("box_score_url", "'https://scores.example.com/boxscores/G' || CAST(o_orderkey AS STRING) || '.html'"),
    ("created_at", "o_orderdate"),
    ("updated_at", "o_orderdate"),
    ("deleted_at", "CASE WHEN o_orderkey % 97 = 0 THEN o_orderdate END"),
]

LINE_SCORES = [
    ("game_id", "'G' || CAST(o_orderkey AS STRING)"),
    ("team", _SIDE_TEAM),
    ("q1", "CAST(20 + (o_orderkey * 3 + s * 5) % 15 AS INT)"),
    ("q2", "CASE WHEN o_orderkey % 41 = 0 AND s = 0 THEN NULL "
           "ELSE CAST(20 + (o_orderkey * 5 + s * 3) % 15 AS INT) END"),
    ("q3", "CAST(20 + (o_orderkey * 7 + s * 2) % 15 AS INT)"),
    ("q4", "CAST(20 + (o_orderkey * 11 + s * 7) % 15 AS INT)"),
    ("ot1", "CASE WHEN o_orderkey % 10 = 0 THEN CAST(5 + (o_orderkey + s) % 9 AS INT) END"),
    ("ot2", "CASE WHEN o_orderkey % 30 = 0 THEN CAST(3 + (o_orderkey + s * 2) % 7 AS INT) END"),
    ("ot3", "CASE WHEN o_orderkey % 90 = 0 THEN CAST(2 + s AS INT) END"),
    ("created_at", "o_orderdate"),
    ("updated_at", "o_orderdate"),
    ("deleted_at", "CASE WHEN o_orderkey % 101 = 0 AND s = 1 THEN o_orderdate END"),
]
LINE_SCORES_POST = [
    ("total", "coalesce(q1, 0) + coalesce(q2, 0) + coalesce(q3, 0) + coalesce(q4, 0) "
              "+ coalesce(ot1, 0) + coalesce(ot2, 0) + coalesce(ot3, 0)"),
]

PLAYER_BASIC = [
    ("game_id", "'G' || CAST(l_orderkey AS STRING)"),
    ("player_id", "'P' || CAST(l_partkey AS STRING)"),
    ("team", _PLAYER_TEAM),
    ("player_name", "'Player ' || CAST(l_partkey AS STRING) "
                    "|| CASE WHEN l_orderkey % 4 = 0 THEN ' Jr' ELSE '' END"),
    ("status", "CASE WHEN l_partkey % 13 = 0 THEN 'Did Not Play' "
               "WHEN l_partkey % 29 = 0 THEN NULL ELSE 'Played' END"),
    ("mp", _PLAYER_MP),
    ("fg", "CAST(qty % 15 AS INT)"),
    ("fga", "CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE CAST(qty % 15 + l_partkey % 7 AS INT) END"),
    ("three_p", "CAST(qty % 4 AS INT)"),
    ("three_pa", "CAST(qty % 4 + l_orderkey % 5 AS INT)"),
    ("ft", "CAST(qty % 5 AS INT)"),
    ("fta", "CAST(qty % 5 + l_partkey % 3 AS INT)"),
    ("orb", "CAST((qty * 3) % 5 AS INT)"),
    ("drb", "CAST((qty * 3) % 11 AS INT)"),
    ("ast", "CAST((l_partkey + l_orderkey) % 12 AS INT)"),
    ("stl", "CAST(l_partkey % 4 AS INT)"),
    ("blk", "CAST(l_orderkey % 11 AS INT)"),
    ("tov", "CAST(qty % 6 AS INT)"),
    ("pf", "CAST(l_partkey % 6 AS INT)"),
    ("pts", "CAST(qty AS INT)"),
    ("fg_percent", _pct("qty % 15", "qty % 15 + l_partkey % 7")),
    ("three_p_percent", _pct("qty % 4", "qty % 4 + l_orderkey % 5")),
    ("ft_percent", _pct("qty % 5", "qty % 5 + l_partkey % 3")),
    ("gm_sc", "CAST((qty * 7) % 300 AS DOUBLE) / 10 - 5"),
    ("plus_minus", "CAST(l_orderkey % 31 - 15 AS INT)"),
    ("created_at", "o_orderdate"),
    ("updated_at", "o_orderdate"),
    ("deleted_at", "CASE WHEN (l_orderkey + l_partkey) % 53 = 0 THEN o_orderdate END"),
]
PLAYER_BASIC_POST = [("trb", "orb + drb")]

PLAYER_ADV = [
    ("game_id", "'G' || CAST(l_orderkey AS STRING)"),
    ("player_id", "'P' || CAST(l_partkey AS STRING)"),
    ("team", _PLAYER_TEAM),
    ("player_name", "'Player ' || CAST(l_partkey AS STRING) "
                    "|| CASE WHEN l_orderkey % 4 = 0 THEN ' Jr' ELSE '' END"),
    ("mp", _PLAYER_MP),
    ("ts_percent", "CAST((qty * 37) % 900 AS DOUBLE) / 1000"),
    ("efg_percent", "CAST((qty * 31) % 800 AS DOUBLE) / 1000"),
    ("three_p_ar", "CAST(l_partkey % 70 AS DOUBLE) / 100"),
    ("f_tr", "CAST(qty % 50 AS DOUBLE) / 100"),
    ("orb_percent", "CAST(l_orderkey % 300 AS DOUBLE) / 10"),
    ("drb_percent", "CAST(l_partkey % 400 AS DOUBLE) / 10"),
    ("trb_percent", "CAST((qty * 3) % 300 AS DOUBLE) / 10"),
    ("ast_percent", "CAST((l_partkey * 7) % 450 AS DOUBLE) / 10"),
    ("stl_percent", "CAST(l_orderkey % 60 AS DOUBLE) / 10"),
    ("blk_percent", "CAST(l_partkey % 80 AS DOUBLE) / 10"),
    ("tov_percent", "CAST(qty % 30 AS DOUBLE)"),
    ("usg_percent", "CASE WHEN l_orderkey % 23 = 0 THEN NULL "
                    "ELSE CAST((l_partkey * 3 + l_orderkey) % 400 AS DOUBLE) / 10 END"),
    ("o_rtg", "80 + CAST((qty * 13) % 600 AS DOUBLE) / 10"),
    ("d_rtg", "90 + CAST((l_orderkey * 7) % 400 AS DOUBLE) / 10"),
    ("bpm", "CAST((l_partkey * 11 + l_orderkey) % 400 AS DOUBLE) / 10 - 20"),
    ("created_at", "o_orderdate"),
    ("updated_at", "o_orderdate"),
    ("deleted_at", "CASE WHEN (l_orderkey + l_partkey) % 59 = 0 THEN o_orderdate END"),
]

TEAM_BASIC = [
    ("game_id", "'G' || CAST(o_orderkey AS STRING)"),
    ("team", _SIDE_TEAM),
    ("mp", "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN 265 ELSE 240 END"),
    ("fg", "CAST(30 + (o_orderkey * 3 + s * 7) % 15 AS INT)"),
    ("fga", "CAST(75 + (o_orderkey + s * 3) % 15 AS INT)"),
    ("three_p", "CAST(5 + (o_orderkey + s) % 10 AS INT)"),
    ("three_pa", "CAST(25 + (o_orderkey * 2 + s) % 12 AS INT)"),
    ("ft", "CAST(10 + (o_orderkey + s * 5) % 12 AS INT)"),
    ("fta", "CAST(15 + (o_orderkey + s) % 10 AS INT)"),
    ("orb", "CAST(5 + (o_orderkey + s) % 8 AS INT)"),
    ("drb", "CAST(25 + (o_orderkey * 3 + s) % 12 AS INT)"),
    ("ast", "CAST(15 + (o_orderkey + s * 2) % 15 AS INT)"),
    ("stl", "CAST(3 + (o_orderkey + s) % 8 AS INT)"),
    ("blk", "CAST(2 + (o_orderkey * 5 + s) % 6 AS INT)"),
    ("tov", "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(8 + (o_orderkey + s * 3) % 10 AS INT) END"),
    ("pf", "CAST(15 + (o_orderkey + s) % 10 AS INT)"),
    ("created_at", "o_orderdate"),
    ("updated_at", "o_orderdate"),
    ("deleted_at", "CASE WHEN o_orderkey % 103 = 0 AND s = 0 THEN o_orderdate END"),
]
TEAM_BASIC_POST = [
    ("trb", "orb + drb"),
    ("pts", "2 * fg + three_p + ft"),
    ("fg_percent", "CAST(fg AS DOUBLE) / fga"),
    ("three_p_percent", "CAST(three_p AS DOUBLE) / three_pa"),
    ("ft_percent", "CAST(ft AS DOUBLE) / fta"),
]

TEAM_ADV = [
    ("game_id", "'G' || CAST(o_orderkey AS STRING)"),
    ("team", _SIDE_TEAM),
    ("mp", "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN 265 ELSE 240 END"),
    ("ts_percent", "CAST(450 + (o_orderkey * 7 + s * 13) % 200 AS DOUBLE) / 1000"),
    ("efg_percent", "CAST(420 + (o_orderkey * 3 + s) % 200 AS DOUBLE) / 1000"),
    ("three_p_ar", "CAST((o_orderkey + s * 3) % 55 AS DOUBLE) / 100"),
    ("f_tr", "CAST(15 + (o_orderkey + s) % 20 AS DOUBLE) / 100"),
    ("orb_percent", "15 + CAST((o_orderkey * 3 + s) % 200 AS DOUBLE) / 10"),
    ("drb_percent", "65 + CAST((o_orderkey * 5 + s) % 200 AS DOUBLE) / 10"),
    ("trb_percent", "45 + CAST((o_orderkey + s) % 100 AS DOUBLE) / 10"),
    ("ast_percent", "45 + CAST((o_orderkey * 11 + s) % 300 AS DOUBLE) / 10"),
    ("stl_percent", "5 + CAST((o_orderkey + s * 7) % 80 AS DOUBLE) / 10"),
    ("blk_percent", "4 + CAST((o_orderkey * 3 + s) % 100 AS DOUBLE) / 10"),
    ("tov_percent", "8 + CAST((o_orderkey + s) % 100 AS DOUBLE) / 10"),
    ("usg_percent", "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(100 AS DOUBLE) END"),
    ("o_rtg", "95 + CAST((o_orderkey * 7 + s * 13) % 300 AS DOUBLE) / 10"),
    ("d_rtg", "95 + CAST((o_orderkey * 11 + s * 5) % 300 AS DOUBLE) / 10"),
    ("created_at", "o_orderdate"),
    ("updated_at", "o_orderdate"),
    ("deleted_at", "CASE WHEN o_orderkey % 107 = 0 AND s = 1 THEN o_orderdate END"),
]

TEAM_MAPPINGS = [("team_abbr", "'T' || CAST(n_nationkey AS STRING)"), ("full_name", "n_name")]
TEAM_MAPPINGS_OLD = [("team_abbr", "'T' || CAST(n_nationkey AS STRING)"),
                     ("full_name", "'OLD_' || n_name")]
ABBR_SELF = [("source_abbr", "'T' || CAST(n_nationkey AS STRING)"),
             ("team_abbr", "'T' || CAST(n_nationkey AS STRING)")]
ABBR_ALIAS = [("source_abbr", "'X' || CAST(n_nationkey AS STRING)"),
              ("team_abbr", "'T' || CAST(n_nationkey AS STRING)")]
ARENA_MAIN = [("arena_name", "'Arena ' || CAST(n_nationkey AS STRING)"), ("city", "r_name"),
              ("state_or_country", "n_name"), ("location", "'Downtown'")]
ARENA_ANNEX = [("arena_name", "'Arena ' || CAST(n_nationkey AS STRING)"), ("city", "'Z_' || n_name"),
               ("state_or_country", "n_name"), ("location", "'Uptown'")]


def _exprs(cols):
    return [f"{e} AS {n}" for n, e in cols]


def _dealt(cols):
    """The expressions on rows that have their ``game_id`` already: as it is the
    column they are dealt out by, it is taken over and not computed again."""
    return [n if n == "game_id" else f"{e} AS {n}" for n, e in cols]


# ------------------------------------------------------------------ Spark
class Raw:
    """Spark DataFrames of the raw tables for one data directory, dealt out by game
    to ``buckets`` partitions (else as many as the session's shuffles have)."""

    def __init__(self, spark: SparkSession, base: str, buckets: int | None = None):
        self.t = Tables(spark, base)
        self.buckets = buckets

    def _by_game(self, df: DataFrame, key: str, *cols: Column | str) -> DataFrame:
        rows = df.select(F.expr(f"'G' || CAST({key} AS STRING)").alias("game_id"), *cols)
        return rows.repartition(self.buckets, "game_id") if self.buckets else rows.repartition("game_id")

    def _shared(self, dealt: DataFrame, *cols: str) -> DataFrame:
        """The same rows, dealt out once for all models of a plan. No filter and no
        pruning of columns passes a generator; else the rows dealt out for one model
        would differ from those of the next, and each model would shuffle its own.
        (Layers dealt out to buckets are written one by one: nothing is shared.)"""
        return dealt if self.buckets else dealt.select("game_id", F.inline(F.array(F.struct(*cols))))

    def _orders(self) -> DataFrame:
        cols = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]
        return self._shared(self._by_game(self.t.orders, "o_orderkey", *cols), *cols)

    def _sides(self) -> DataFrame:
        return self._orders().select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("s"))

    def _player_base(self) -> DataFrame:
        grouped = (self._by_game(self.t.lineitem, "l_orderkey", "l_partkey", "l_quantity")
                   .groupBy("game_id", "l_partkey").agg(F.sum("l_quantity").cast("int").alias("qty")))
        o = self._orders().select("game_id", F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
        return self._shared(grouped, "l_partkey", "qty").join(o, "game_id", "inner")

    @property
    def games(self) -> DataFrame:
        o = self._orders().alias("o")
        n = self.t.nation
        # nation has one row per team: a fixed, tiny table
        h = n.alias("h")
        v = n.alias("v")
        j = (o.join(h, F.expr("h.n_nationkey = o.o_custkey % 25"), "left")
             .join(v, F.expr("v.n_nationkey = (o.o_custkey + 1 + o.o_orderkey % 24) % 25"), "left"))
        return j.selectExpr(*_dealt(GAMES))

    @property
    def line_scores(self) -> DataFrame:
        return self._sides().selectExpr(*_dealt(LINE_SCORES)).selectExpr("*", *_exprs(LINE_SCORES_POST))

    @property
    def player_game_basic_stats(self) -> DataFrame:
        return (self._player_base().selectExpr(*_dealt(PLAYER_BASIC))
                .selectExpr("*", *_exprs(PLAYER_BASIC_POST)))

    @property
    def player_game_adv_stats(self) -> DataFrame:
        return (self._player_base().filter(F.col("l_partkey") % 11 != 0)
                .selectExpr(*_dealt(PLAYER_ADV)))

    @property
    def team_game_basic_stats(self) -> DataFrame:
        return self._sides().selectExpr(*_dealt(TEAM_BASIC)).selectExpr("*", *_exprs(TEAM_BASIC_POST))

    @property
    def team_game_adv_stats(self) -> DataFrame:
        return self._sides().selectExpr(*_dealt(TEAM_ADV))

    @property
    def team_mappings(self) -> DataFrame:
        n = self.t.nation
        return (n.selectExpr(*_exprs(TEAM_MAPPINGS))
                .unionByName(n.filter(F.col("n_nationkey") % 7 == 0).selectExpr(*_exprs(TEAM_MAPPINGS_OLD))))

    @property
    def team_abbreviation_mappings(self) -> DataFrame:
        n = self.t.nation
        return n.selectExpr(*_exprs(ABBR_SELF)).unionByName(n.selectExpr(*_exprs(ABBR_ALIAS)))

    @property
    def arena_mappings(self) -> DataFrame:
        nr = self.t.nation.join(self.t.region,
                                F.col("n_regionkey") == F.col("r_regionkey"), "inner")
        return (nr.selectExpr(*_exprs(ARENA_MAIN))
                .unionByName(nr.filter(F.col("n_nationkey") % 5 == 0).selectExpr(*_exprs(ARENA_ANNEX))))


# ------------------------------------------------------------------ DuckDB
def _sel(cols) -> str:
    return ",\n    ".join(_exprs(cols))


RAW_SQL_CTES = f"""
raw_games AS (
  SELECT {_sel(GAMES)}
  FROM orders o
  LEFT JOIN nation h ON h.n_nationkey = o.o_custkey % 25
  LEFT JOIN nation v ON v.n_nationkey = (o.o_custkey + 1 + o.o_orderkey % 24) % 25
),
raw_sides AS (SELECT o.*, s FROM orders o CROSS JOIN (SELECT unnest([0, 1]) AS s) sd),
raw_line_scores AS (
  SELECT *, {_sel(LINE_SCORES_POST)} FROM (SELECT {_sel(LINE_SCORES)} FROM raw_sides) x
),
raw_player_base AS (
  SELECT g.l_orderkey, g.l_partkey, g.qty, o.o_custkey, o.o_orderdate
  FROM (SELECT l_orderkey, l_partkey, CAST(sum(l_quantity) AS INT) AS qty
        FROM lineitem GROUP BY l_orderkey, l_partkey) g
  JOIN orders o ON g.l_orderkey = o.o_orderkey
),
raw_player_game_basic_stats AS (
  SELECT *, {_sel(PLAYER_BASIC_POST)} FROM (SELECT {_sel(PLAYER_BASIC)} FROM raw_player_base) x
),
raw_player_game_adv_stats AS (
  SELECT {_sel(PLAYER_ADV)} FROM raw_player_base WHERE l_partkey % 11 <> 0
),
raw_team_game_basic_stats AS (
  SELECT *, {_sel(TEAM_BASIC_POST)} FROM (SELECT {_sel(TEAM_BASIC)} FROM raw_sides) x
),
raw_team_game_adv_stats AS (SELECT {_sel(TEAM_ADV)} FROM raw_sides),
seed_team_mappings AS (
  SELECT {_sel(TEAM_MAPPINGS)} FROM nation
  UNION ALL SELECT {_sel(TEAM_MAPPINGS_OLD)} FROM nation WHERE n_nationkey % 7 = 0
),
seed_team_abbreviation_mappings AS (
  SELECT {_sel(ABBR_SELF)} FROM nation UNION ALL SELECT {_sel(ABBR_ALIAS)} FROM nation
),
seed_arena_mappings AS (
  SELECT {_sel(ARENA_MAIN)} FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT {_sel(ARENA_ANNEX)} FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 = 0
)"""
