"""Facts (M17-M20): natural keys -> dimension keys, incremental windows.

Lookups are chained left joins: the optimizer broadcasts a dimension only when
it measures it small, else it shuffles both sides. The player fact, the widest,
says which dimensions are bounded, and looks its players up from where it lies.

``since``: optional one-row DataFrame with column ``since`` (a date): the
incremental look-back filter. It is applied where the reference applies it
(see H5: before or after the lookups), as a scalar subquery of the same plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ... import functions as X
from ...operators.joins import lookup, lookup_from_afar, other_side
from ...operators.reshape import unpivot_groups
from .dimensions import ARCHETYPE_COLS

LINE_SCORE_PERIODS = ["q1_points", "q2_points", "q3_points", "q4_points",
                      "ot1_points", "ot2_points", "ot3_points"]


def lookback_since(target: DataFrame, days: int = 30, date_col: str = "game_date") -> DataFrame:
    """One-row frame: ``max(date_col) - days`` of the target."""
    return target.agg((F.max(F.col(date_col).cast("date")) - F.expr(f"INTERVAL {days} DAYS"))
                      .alias("since"))


def _since_filter(df: DataFrame, since: DataFrame | None, col: Column | str) -> DataFrame:
    """Keep rows on or after the look-back start, a scalar subquery. An empty
    target (no start) keeps nothing, as ``x >= NULL`` does in SQL."""
    if since is None:
        return df
    c = F.col(col) if isinstance(col, str) else col
    return df.filter(c >= since.select("since").scalar())


def _team_lookup(df, dim_teams, expr, out, bounded=False):
    return lookup(df, dim_teams, [(expr, "team_abbr")], [("team_key", out)], bounded=bounded)


def fct_game_results(ge: DataFrame, dim_dates: DataFrame, dim_seasons: DataFrame,
                     dim_arenas: DataFrame, dim_teams: DataFrame,
                     since: DataFrame | None = None) -> DataFrame:
    ge = _since_filter(ge, since, "game_date")
    gdate = F.col("game_date").cast("date")
    df = lookup(ge, dim_dates, [(gdate, "full_date")], [("date_key", "date_key")])
    df = lookup(df, dim_seasons, [("season_start_year", "season_start_year")],
                [("season_key", "season_key")])
    df = lookup(df, dim_arenas, [("arena", "arena_name"), ("arena_city", "arena_city")],
                [("arena_key", "arena_key")])
    df = _team_lookup(df, dim_teams, "home_team", "home_team_key")
    df = _team_lookup(df, dim_teams, "visitor_team", "visitor_team_key")
    df = _team_lookup(df, dim_teams, "winning_team", "winning_team_key")
    return df.select(
        X.surrogate_key("game_id").alias("game_key"), "date_key", "season_key", "arena_key",
        "home_team_key", "visitor_team_key", "winning_team_key", "game_id", "home_points",
        "visitor_points", "point_differential", "total_points", "is_playoff", "is_overtime",
        F.coalesce(F.col("home_points") > F.col("visitor_points"), F.lit(False))
        .alias("is_home_team_winner"),
        "home_net_rating", "visitor_net_rating", "matchup_pace",
        X.tier("point_differential", [(5, "Clutch Game"), (10, "Competitive"), (20, "Decisive")],
               "Blowout", op="<=").alias("game_competitiveness_tier"),
        gdate.alias("game_date"))


def fct_player_game_stats(pp: DataFrame, ge: DataFrame, dim_archetypes: DataFrame,
                          dim_players: DataFrame, dim_teams: DataFrame, dim_dates: DataFrame,
                          dim_seasons: DataFrame, dim_arenas: DataFrame,
                          since: DataFrame | None = None) -> DataFrame:
    """Player-game fact: one row per player and game."""
    gd = ge.select(F.col("game_id").alias("gd_game_id"), F.col("arena").alias("gd_arena_name"),
                   F.col("arena_city").alias("gd_arena_city"))
    # the look-back reads a column that no left join changes: the lookups see its rows only
    df = _since_filter(pp, since, "game_date")
    # players grow with the data; the other dimensions are bounded. No wide row is shuffled
    df = lookup_from_afar(df, dim_players, "player_id", "player_id", [("player_key", "player_key")], at="game_id")
    df = df.join(gd, F.col("game_id") == F.col("gd_game_id"), "left")
    # nine-column junk-dimension join with plain '=' (NULL never matches, J5)
    df = lookup(df, dim_archetypes, [(c, c) for c in ARCHETYPE_COLS],
                [("archetype_key", "archetype_key")], bounded=True)
    df = _team_lookup(df, dim_teams, "team", "team_key", bounded=True)
    gdate = F.col("game_date").cast("date")
    df = lookup(df, dim_dates, [(gdate, "full_date")], [("date_key", "date_key")], bounded=True)
    df = lookup(df, dim_seasons, [("season_start_year", "season_start_year")],
                [("season_key", "season_key")], bounded=True)
    df = lookup(df, dim_arenas, [("gd_arena_name", "arena_name"), ("gd_arena_city", "arena_city")],
                [("arena_key", "arena_key")], bounded=True)
    return df.select(
        X.surrogate_key("game_id", "player_id").alias("player_game_key"), "player_key",
        "team_key", "date_key", "season_key", "arena_key", "archetype_key", "game_id",
        "minutes_played", "points", "assists", "total_rebounds", "steals", "blocks", "turnovers",
        "plus_minus", "net_rating", "box_plus_minus", "field_goals_made", "field_goals_attempted",
        "three_pointers_made", "three_pointers_attempted", "true_shooting_pct",
        "effective_fg_pct", "usage_pct", "offensive_rating", "defensive_rating",
        gdate.alias("game_date"))


def fct_quarter_scoring(stg_line_scores: DataFrame, ge: DataFrame,
                        team_abbreviation_mappings: DataFrame, dim_teams: DataFrame,
                        dim_dates: DataFrame, dim_seasons: DataFrame,
                        since: DataFrame | None = None) -> DataFrame:
    games = _since_filter(ge.select("game_id", "game_date", "season_start_year"), since,
                          "game_date")
    # pre-filter by the games in range
    ls = (stg_line_scores.select("game_id", "team", *LINE_SCORE_PERIODS)
          .join(games.select("game_id"), "game_id", "left_semi"))
    # every lookup and the opponent's row (J7) at the grain game x team; the
    # periods are unpivoted last
    df = other_side(ls, ["game_id"], "team", LINE_SCORE_PERIODS, prefix="o_")
    g = games.select(F.col("game_id").alias("g_game_id"), "game_date", "season_start_year")
    df = df.join(g, F.col("game_id") == F.col("g_game_id"), "inner")
    df = lookup(df, team_abbreviation_mappings, [("team", "source_abbr")], [("team_abbr", "team_abbr")])
    df = lookup(df, team_abbreviation_mappings, [("o_team", "source_abbr")], [("team_abbr", "opp_abbr")])
    df = _team_lookup(df, dim_teams, "team_abbr", "team_key")
    df = _team_lookup(df, dim_teams, "opp_abbr", "opponent_key")
    gdate = F.col("game_date").cast("date")
    df = lookup(df, dim_dates, [(gdate, "full_date")], [("date_key", "date_key")])
    df = lookup(df, dim_seasons, [("season_start_year", "season_start_year")], [("season_key", "season_key")])
    df = unpivot_groups(df, ["game_id", "team_abbr", "date_key", "season_key", "team_key", "opponent_key", "game_date"],
                        {p: {"points_scored": p, "opponent_points_scored": f"o_{p}"}
                         for p in LINE_SCORE_PERIODS},
                        field_name="period_name", cast_to="int")
    df = df.filter(F.col("points_scored").isNotNull())
    return df.select(
        X.surrogate_key("game_id", "team_abbr", "period_name").alias("quarter_scoring_key"),
        "date_key", "season_key", "team_key", "opponent_key", "game_id",
        X.strip_label("period_name", "_POINTS").alias("period"), "points_scored",
        "opponent_points_scored",
        (F.col("points_scored") - F.col("opponent_points_scored")).alias("period_point_differential"),
        gdate.alias("game_date"))


def fct_team_game_stats(tp: DataFrame, ge: DataFrame, dim_teams: DataFrame, dim_dates: DataFrame,
                        dim_seasons: DataFrame, dim_arenas: DataFrame,
                        since: DataFrame | None = None) -> DataFrame:
    gd = ge.select(F.col("game_id").alias("gd_game_id"), F.col("game_date").alias("gd_game_date"),
                   F.col("season_start_year").alias("gd_season"),
                   F.col("home_team").alias("gd_home"), F.col("visitor_team").alias("gd_visitor"),
                   F.col("arena").alias("gd_arena_name"), F.col("arena_city").alias("gd_arena_city"))
    df = tp.join(gd, F.col("game_id") == F.col("gd_game_id"), "left")
    df = _team_lookup(df, dim_teams, "team", "team_key")
    opp_code = F.when(F.col("team") == F.col("gd_home"), F.col("gd_visitor")).otherwise(F.col("gd_home"))
    df = _team_lookup(df, dim_teams, opp_code, "opponent_key")
    gdate = F.col("gd_game_date").cast("date")
    df = lookup(df, dim_dates, [(gdate, "full_date")], [("date_key", "date_key")])
    df = lookup(df, dim_seasons, [("gd_season", "season_start_year")],
                [("season_key", "season_key")])
    df = lookup(df, dim_arenas, [("gd_arena_name", "arena_name"), ("gd_arena_city", "arena_city")],
                [("arena_key", "arena_key")])
    df = _since_filter(df, since, "gd_game_date")
    return df.select(
        X.surrogate_key("game_id", "team").alias("team_game_key"), "team_key", "date_key",
        "season_key", "arena_key", "opponent_key", "game_id",
        (F.col("team") == F.col("gd_home")).alias("is_home_team"), "points",
        "offensive_rating", "defensive_rating", "net_rating", "pace", "effective_fg_pct",
        "turnover_rate", "offensive_tier", "defensive_tier", gdate.alias("game_date"))
