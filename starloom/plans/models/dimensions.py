"""Dimensions.

Final ``ORDER BY`` of the reference is not applied inside the models: a
global sort is a range shuffle that no consumer needs (Parquet writers sort
within partitions when asked, see ``sources.sinks``). ``ordered=True``
adds it for display.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import functions as X
from ...operators.dedupe import latest_per_key
from ...operators.series import day_series_inclusive

ARCHETYPE_COLS = ["usage_tier", "impact_tier", "shooting_efficiency_tier", "minutes_based_role",
                  "is_double_double", "is_triple_double", "is_versatile",
                  "is_defensive_specialist", "is_three_and_d"]


def _maybe_sorted(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols]) if ordered else df


def dim_arenas(arena_mappings: DataFrame, ordered: bool = False) -> DataFrame:
    df = arena_mappings.select(
        X.surrogate_key("arena_name", "city").alias("arena_key"), "arena_name",
        F.col("city").alias("arena_city"), F.col("state_or_country").alias("arena_state_or_country"),
        F.col("location").alias("arena_location"))
    return _maybe_sorted(df, ordered, "arena_name", "arena_city")


def dim_dates(stg_games: DataFrame, ordered: bool = False) -> DataFrame:
    """Every day from the first to the last game (both included, G3).

    The bounds are a one-row aggregate (partial min/max in every task) and
    the series is generated from it lazily: no value goes to the driver.
    """
    bounds = stg_games.agg(F.min(F.col("game_date").cast("date")).alias("start_date"),
                           F.max(F.col("game_date").cast("date")).alias("end_date"))
    days = day_series_inclusive(bounds, "start_date", "end_date", "date_day")
    parts = X.date_parts("date_day")
    df = days.select(*[c.alias(n) for n, c in parts.items()])
    return _maybe_sorted(df, ordered, "full_date")


def dim_player_game_archetypes(int_player_perf: DataFrame) -> DataFrame:
    distinct = int_player_perf.select(*ARCHETYPE_COLS).distinct()
    return distinct.select(X.surrogate_key(*ARCHETYPE_COLS).alias("archetype_key"), *ARCHETYPE_COLS)


def dim_players(stg_basic: DataFrame, stg_games: DataFrame, ordered: bool = False) -> DataFrame:
    """Newest name per player (W1): game date descending, NULL dates first.

    The latest row is picked by a partial aggregate (see ``deduplicate``),
    so a player with a huge number of rows never lands whole in one task.
    """
    games = stg_games.select(F.col("game_id").alias("g_game_id"), "game_date")
    stats = (stg_basic.select("player_id", "player_name", "game_id")
             .join(games, F.col("game_id") == F.col("g_game_id"), "left")
             .select("player_id", "player_name", "game_date", "game_id"))
    latest = latest_per_key(stats, "player_id", "game_date")
    df = latest.select(X.surrogate_key("player_id").alias("player_key"), "player_id", "player_name")
    return _maybe_sorted(df, ordered, "player_name")


def dim_seasons(games: DataFrame, ordered: bool = False) -> DataFrame:
    """Seasons of the enriched games."""
    seasons = games.select("season_start_year").distinct()
    df = seasons.select(X.surrogate_key("season_start_year").alias("season_key"),
                        "season_start_year",
                        X.season_label("season_start_year").alias("season_display"))
    return _maybe_sorted(df, ordered, "season_start_year")


def dim_teams(team_mappings: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per team *name*; the key hashes the code only, so a code with
    two names has two rows with one key (kept as in the reference)."""
    df = team_mappings.select(X.surrogate_key("team_abbr").alias("team_key"), "team_abbr",
                              F.col("full_name").alias("team_full_name"))
    return _maybe_sorted(df, ordered, "team_abbr")
