"""Intermediate layer (M8-M10): conformed team codes, joined box scores.

The big inputs meet in shuffle joins on ``game_id`` (and ``player_id``/team);
a side is broadcast only where the optimizer measures it small, or where it is
a seed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators.dedupe import first_per_key
from ...operators.joins import conform


def _games_with_codes(stg_games: DataFrame, team_mappings: DataFrame, roles: dict[str, str],
                      cols: list[str]) -> DataFrame:
    """stg_games joined to the team-name seed once per role.

    ``roles`` maps a stg_games name column to the output code column. The
    seed may hold several names per code, and a name maps to one code.
    """
    g = stg_games.select(*cols, *roles.keys())
    for src, out in roles.items():
        m = team_mappings.select(F.col("full_name").alias(f"__fn_{out}"), F.col("team_abbr").alias(out))
        g = g.join(m, F.col(src) == F.col(f"__fn_{out}"), "left").drop(f"__fn_{out}")
    return g


def int_player_performance(stg_basic: DataFrame, stg_adv: DataFrame, stg_games: DataFrame,
                           team_abbreviation_mappings: DataFrame,
                           team_mappings: DataFrame) -> DataFrame:
    basic = conform(stg_basic.filter(F.col("did_play")), team_abbreviation_mappings,
                    "team", "source_abbr", "team_abbr", "team_conformed")
    adv = stg_adv.select(
        F.col("game_id").alias("a_game_id"), F.col("player_id").alias("a_player_id"),
        "net_rating", "box_plus_minus", "true_shooting_pct", "effective_fg_pct", "usage_pct",
        "offensive_rating", "defensive_rating", "usage_tier", "impact_tier",
        "shooting_efficiency_tier", "minutes_based_role", "is_versatile",
        "is_defensive_specialist", "is_three_and_d")
    games = _games_with_codes(stg_games, team_mappings,
                              {"home_team": "home_team_abbr", "winning_team": "winning_team_abbr"},
                              ["game_id", "game_date", "season_start_year", "is_playoff"])
    games = games.select(F.col("game_id").alias("g_game_id"), "game_date", "season_start_year",
                         "is_playoff", "home_team_abbr", "winning_team_abbr")
    # the join by more keys last: its rows are left sorted by game and player
    j = (basic.join(games, F.col("game_id") == F.col("g_game_id"), "left")
         .join(adv, (F.col("game_id") == F.col("a_game_id"))
               & (F.col("player_id") == F.col("a_player_id")), "left"))
    tc = F.col("team_conformed")
    return j.select(
        "game_id", "player_id", "player_name", tc.alias("team"), "game_date", "season_start_year",
        "is_playoff",
        F.when(tc == F.col("winning_team_abbr"), "W").otherwise("L").alias("game_result"),
        F.when(tc == F.col("home_team_abbr"), "HOME").otherwise("AWAY").alias("team_location"),
        "minutes_played", "points", "assists", "total_rebounds", "steals", "blocks", "turnovers",
        "plus_minus", "net_rating", "box_plus_minus", "field_goals_made", "field_goals_attempted",
        "field_goal_pct", "three_pointers_made", "three_pointers_attempted", "three_point_pct",
        "true_shooting_pct", "effective_fg_pct", "usage_pct", "offensive_rating",
        "defensive_rating", "usage_tier", "impact_tier", "shooting_efficiency_tier",
        "minutes_based_role", "is_double_double", "is_triple_double", "is_versatile",
        "is_defensive_specialist", "is_three_and_d")


def int_team_performance(stg_basic: DataFrame, stg_adv: DataFrame, stg_games: DataFrame,
                         team_abbreviation_mappings: DataFrame,
                         team_mappings: DataFrame) -> DataFrame:
    basic = conform(stg_basic, team_abbreviation_mappings, "team", "source_abbr", "team_abbr",
                    "team_conformed")
    adv = conform(stg_adv, team_abbreviation_mappings, "team", "source_abbr", "team_abbr",
                  "a_team_conformed")
    adv = adv.select(F.col("game_id").alias("a_game_id"), "a_team_conformed", "offensive_rating",
                     "defensive_rating", "net_rating", "offensive_tier", "defensive_tier",
                     "shot_selection_style", "ball_movement_style", "ball_security_tier",
                     "defensive_activity")
    games = _games_with_codes(stg_games, team_mappings,
                              {"home_team": "home_team_abbr", "visitor_team": "visitor_team_abbr",
                               "winning_team": "winning_team_abbr"},
                              ["game_id", "game_date", "season_start_year", "is_playoff"])
    games = games.select(F.col("game_id").alias("g_game_id"), "game_date", "season_start_year",
                         "is_playoff", "home_team_abbr", "visitor_team_abbr", "winning_team_abbr")
    j = (basic.join(adv, (F.col("game_id") == F.col("a_game_id"))
                    & (F.col("team_conformed") == F.col("a_team_conformed")), "left")
         .join(games, F.col("game_id") == F.col("g_game_id"), "left"))
    tc = F.col("team_conformed")
    return j.select(
        "game_id", tc.alias("team"), "game_date", "season_start_year", "is_playoff",
        F.when(tc == F.col("winning_team_abbr"), "W").otherwise("L").alias("game_result"),
        F.when(tc == F.col("home_team_abbr"), F.col("visitor_team_abbr"))
        .otherwise(F.col("home_team_abbr")).alias("opponent_team"),
        "points", "offensive_rating", "defensive_rating", "net_rating", "pace",
        "effective_fg_pct", "turnover_rate", "offensive_rebound_rate", "free_throw_rate",
        "offensive_tier", "defensive_tier", "shot_selection_style", "ball_movement_style",
        "ball_security_tier", "defensive_activity")


_SIDE_STATS = ["offensive_rating", "defensive_rating", "net_rating", "pace", "effective_fg_pct",
               "turnover_rate", "offensive_tier", "defensive_tier"]


def int_games_enriched(stg_games: DataFrame, int_team_perf: DataFrame, team_mappings: DataFrame,
                       arena_mappings: DataFrame) -> DataFrame:
    games = _games_with_codes(
        stg_games, team_mappings,
        {"home_team": "home_team_abbr", "visitor_team": "visitor_team_abbr",
         "winning_team": "winning_team_abbr"},
        ["game_id", "game_date", "season_start_year", "is_playoff", "arena", "home_points",
         "visitor_points", "point_differential", "total_points", "is_overtime"])
    # one city per arena name: the first by city (W2); bounded seed table
    arenas = first_per_key(arena_mappings.select("arena_name", F.col("city").alias("arena_city")),
                           "arena_name", "arena_city")
    g = games.join(F.broadcast(arenas), games.arena == arenas.arena_name, "left")

    def side(prefix: str) -> DataFrame:
        return int_team_perf.select(
            F.col("game_id").alias(f"{prefix}_gid"), F.col("team").alias(f"{prefix}_tm"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in _SIDE_STATS])

    home, visitor = side("home"), side("visitor")
    g = (g.join(home, (F.col("game_id") == F.col("home_gid"))
                & (F.col("home_team_abbr") == F.col("home_tm")), "left")
         .join(visitor, (F.col("game_id") == F.col("visitor_gid"))
               & (F.col("visitor_team_abbr") == F.col("visitor_tm")), "left"))
    return g.select(
        "game_id", "game_date", "season_start_year", "is_playoff", "arena", "arena_city",
        F.col("home_team_abbr").alias("home_team"), F.col("visitor_team_abbr").alias("visitor_team"),
        F.col("winning_team_abbr").alias("winning_team"), "home_points", "visitor_points",
        "point_differential", "total_points", "is_overtime",
        *[F.col(f"home_{c}") for c in _SIDE_STATS],
        *[F.col(f"visitor_{c}") for c in _SIDE_STATS],
        ((F.col("home_pace") + F.col("visitor_pace")) / 2).alias("matchup_pace"))
