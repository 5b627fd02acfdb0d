"""Staging layer (M1-M7): cleaned views of the raw tables.

Each model is ``DataFrame(s) -> DataFrame``: soft-deleted rows and rows
without keys are dropped in the scan (pushed filters), NULL measures get
defaults, and derived labels are CASE expressions. Load timestamps are a
sink concern (added at write time), so results are reproducible.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ... import functions as X
from ...operators.aggregates import any_match
from ...sources.tables import scan_live


# Thresholds of the extended player model, as the reference
# states them (minutes, usage %, box plus/minus).
@dataclass(frozen=True)
class MinuteThresholds:
    insufficient: float = 5
    p5: float = 6
    q1_val: float = 16.18
    q1_cat: float = 16
    median_val: float = 24.38
    median_cat: float = 24
    q3_val: float = 32.18
    q3_cat: float = 32
    p90: float = 36
    p95: float = 39


@dataclass(frozen=True)
class UsageThresholds:
    p5: float = 7.3
    q1: float = 13.4
    median: float = 18.4
    q3: float = 24.2
    p90: float = 30.2
    p95: float = 33.1


@dataclass(frozen=True)
class BpmThresholds:
    p5: float = -15.6
    q1: float = -6.3
    median: float = -0.6
    q3: float = 4.8
    p90: float = 10.1
    p95: float = 13.9


MINUTES = MinuteThresholds()
USAGE = UsageThresholds()
BPM = BpmThresholds()

# Start-time patterns of the time-slot label, in rule order.
TIME_SLOT_RULES = [
    (["%12:%p%"], "Afternoon"),
    (["%1:%p%", "%2:%p%", "%3:%p%"], "Afternoon"),
    (["%7:%p%", "%8:%p%"], "Prime Time"),
]


def time_slot(c) -> Column:
    return X.like_classify(c, TIME_SLOT_RULES, "Late Night")


def _z(c, default=0) -> Column:
    return X.coalesce_zero(c, default)


# -------------------------------------------------------------- M2
def stg_line_scores(line_scores: DataFrame) -> DataFrame:
    src = scan_live(line_scores, required=("game_id", "team"))
    q = [_z(c) for c in ("q1", "q2", "q3", "q4")]
    ot = [_z(c) for c in ("ot1", "ot2", "ot3")]
    m2, m3, m4 = X.deltas(["q1", "q2", "q3", "q4"])
    return src.select(
        "game_id", "team",
        q[0].alias("q1_points"), q[1].alias("q2_points"), q[2].alias("q3_points"),
        q[3].alias("q4_points"), ot[0].alias("ot1_points"), ot[1].alias("ot2_points"),
        ot[2].alias("ot3_points"), F.col("total").alias("total_points"),
        (q[0] + q[1]).alias("first_half_points"), (q[2] + q[3]).alias("second_half_points"),
        X.safe_add(q).alias("regulation_points"), X.safe_add(ot).alias("overtime_points"),
        (ot[0] > 0).alias("had_ot1"), (ot[1] > 0).alias("had_ot2"), (ot[2] > 0).alias("had_ot3"),
        m2.alias("q2_momentum"), m3.alias("q3_momentum"), m4.alias("q4_momentum"),
        F.greatest(*q).alias("max_quarter_score"), F.least(*q).alias("min_quarter_score"),
        X.row_argmax(q, ["Q1", "Q2", "Q3", "Q4"]).alias("best_quarter"),
        "created_at", "updated_at")


# -------------------------------------------------------------- M1
def stg_games(games: DataFrame, stg_line_scores_df: DataFrame) -> DataFrame:
    overtime = (stg_line_scores_df.groupBy("game_id")
                .agg(any_match(F.col("overtime_points") > 0).alias("had_overtime")))
    src = scan_live(games, required=("game_id", "date", "home_team", "visitor_team"))
    d = F.col("date")
    out = X.two_side_outcome("home_pts", "visitor_pts", "home_team", "visitor_team")
    g = src.join(overtime, "game_id", "left")
    return g.select(
        "game_id", "home_team", "visitor_team",
        d.alias("game_date"), F.year(d).alias("season_year"),
        X.season_start_year(d).alias("season_start_year"),
        F.month(d).alias("game_month"), F.dayofmonth(d).alias("game_day"),
        X.day_name(d, padded=True).alias("game_day_of_week"),
        "is_playoff", "start_time_et", time_slot("start_time_et").alias("game_time_slot"),
        "arena", F.col("home_pts").alias("home_points"), F.col("visitor_pts").alias("visitor_points"),
        out["winner"].alias("winning_team"), out["loser"].alias("losing_team"),
        out["side"].alias("winner_location"), out["abs_diff"].alias("point_differential"),
        out["total"].alias("total_points"), "game_duration",
        F.coalesce(F.col("had_overtime") == 1, F.lit(False)).alias("is_overtime"),
        "box_score_url", "created_at", "updated_at")


# -------------------------------------------------------------- M3
def stg_player_game_basic_stats(src_df: DataFrame) -> DataFrame:
    src = scan_live(src_df, required=("game_id", "player_id"))
    z = _z
    two_m = z("fg") - z("three_p")
    two_a = z("fga") - z("three_pa")
    n10 = X.threshold_count(["pts", "trb", "ast", "stl", "blk"], 10)
    mp = F.col("mp")
    return src.select(
        "game_id", "player_id", "team", "player_name",
        F.coalesce(F.col("status"), F.lit("Unknown")).alias("player_status"),
        F.coalesce(F.col("status") == "Played", F.lit(False)).alias("did_play"),
        mp.alias("minutes_played_str"),
        X.clock_to_minutes(mp).cast("decimal(10,2)").alias("minutes_played"),
        z("fg").alias("field_goals_made"), z("fga").alias("field_goals_attempted"),
        z("fg_percent").alias("field_goal_pct"),
        z("three_p").alias("three_pointers_made"), z("three_pa").alias("three_pointers_attempted"),
        z("three_p_percent").alias("three_point_pct"),
        z("ft").alias("free_throws_made"), z("fta").alias("free_throws_attempted"),
        z("ft_percent").alias("free_throw_pct"),
        z("orb").alias("offensive_rebounds"), z("drb").alias("defensive_rebounds"),
        z("trb").alias("total_rebounds"), z("ast").alias("assists"), z("stl").alias("steals"),
        z("blk").alias("blocks"), z("tov").alias("turnovers"), z("pf").alias("personal_fouls"),
        z("pts").alias("points"), z("gm_sc").alias("game_score"), z("plus_minus").alias("plus_minus"),
        two_m.alias("two_pointers_made"), two_a.alias("two_pointers_attempted"),
        X.ratio_or_zero(two_m, two_a).alias("two_point_pct"),
        X.ratio_or_zero(z("pts"), z("fga")).alias("points_per_shot"),
        (n10 >= 2).alias("is_double_double"), (n10 >= 3).alias("is_triple_double"),
        F.coalesce(mp.like("%:%") & (F.split_part(mp, F.lit(":"), F.lit(1)).cast("double") >= 20),
                   F.lit(False)).alias("likely_starter"),
        "created_at", "updated_at")


# -------------------------------------------------------------- M4
def stg_player_game_adv_stats(src_df: DataFrame) -> DataFrame:
    src = scan_live(src_df, required=("game_id", "player_id"))
    m = X.clock_to_minutes("mp")
    src = src.withColumn("__min", m)
    mins = F.col("__min")
    z = _z
    few = mins < 5
    usage = X.case([
        (few, "Garbage Time"),
        (mins < 15, "Limited Minutes"),
        (((mins >= 30) & (z("usg_percent") >= 22)) | ((mins >= 25) & (z("usg_percent") >= 25)),
         "Primary Option"),
        ((mins >= 20) & (z("usg_percent") >= 20), "Secondary Option"),
        (mins >= 15, "Role Player"),
    ], "Limited Minutes")
    return src.select(
        "game_id", "player_id", "team", "player_name",
        F.col("mp").alias("minutes_played_str"), mins.alias("minutes_played"),
        *_adv_base_metrics(),
        X.tier(z("ts_percent"), [(0.60, "Elite"), (0.55, "Good"), (0.50, "Average")],
               "Below Average", guards=[(few, "Insufficient Minutes")]).alias("shooting_efficiency_tier"),
        usage.alias("usage_tier"),
        X.tier(z("bpm"), [(10, "Elite Impact"), (5, "High Impact"), (0, "Positive Impact"),
                          (-5, "Negative Impact")], "Very Negative Impact",
               guards=[(few, "Insufficient Minutes")]).alias("impact_tier"),
        X.tier(mins, [(32, "Starter/Key Player"), (20, "Rotation Player"), (10, "Bench Player"),
                      (5, "Deep Bench")], "Garbage Time").alias("minutes_based_role"),
        ((mins >= 15) & (z("ast_percent") >= 20) & (z("trb_percent") >= 15)).alias("is_versatile"),
        ((mins >= 15) & ((z("stl_percent") >= 2.5) | (z("blk_percent") >= 4))
         & (z("d_rtg") < 105)).alias("is_defensive_specialist"),
        ((mins >= 15) & (z("three_p_ar") >= 0.4) & (z("d_rtg") < 110)).alias("is_three_and_d"),
        "created_at", "updated_at")


def _adv_base_metrics() -> list[Column]:
    z = _z
    return [
        z("ts_percent").alias("true_shooting_pct"), z("efg_percent").alias("effective_fg_pct"),
        z("three_p_ar").alias("three_point_attempt_rate"), z("f_tr").alias("free_throw_rate"),
        z("orb_percent").alias("offensive_rebound_pct"), z("drb_percent").alias("defensive_rebound_pct"),
        z("trb_percent").alias("total_rebound_pct"), z("ast_percent").alias("assist_pct"),
        z("stl_percent").alias("steal_pct"), z("blk_percent").alias("block_pct"),
        z("tov_percent").alias("turnover_pct"), z("usg_percent").alias("usage_pct"),
        z("o_rtg").alias("offensive_rating"), z("d_rtg").alias("defensive_rating"),
        z("bpm").alias("box_plus_minus"), (z("o_rtg") - z("d_rtg")).alias("net_rating"),
    ]


# -------------------------------------------------------------- M5
def stg_player_game_adv_stats_extended(src_df: DataFrame) -> DataFrame:
    src = scan_live(src_df, required=("game_id", "player_id"))
    src = src.withColumn("__min", X.clock_to_minutes("mp", guarded=True))
    mins = F.col("__min")
    usg, bpm, ts = _z("usg_percent"), _z("bpm"), _z("ts_percent")
    M, U, B = MINUTES, USAGE, BPM
    few = mins < M.insufficient
    meaningful = mins >= M.q1_cat
    return src.select(
        "game_id", "player_id", "team", "player_name",
        F.col("mp").alias("minutes_played_str"), mins.alias("minutes_played"),
        *_adv_base_metrics(),
        X.tier(mins, [(M.p95, "Elite Minutes (Top 5%)"), (M.p90, "Elite Minutes (Top 10%)"),
                      (M.q3_cat, "Starter"), (M.median_cat, "Key Rotation"),
                      (M.q1_cat, "Regular Rotation"), (M.p5, "Deep Bench"),
                      (M.insufficient, "Garbage Time")], "Insufficient Minutes")
        .alias("minutes_based_role"),
        X.tier(mins, [(M.insufficient, "Insufficient"), (M.q1_val, "Q1"), (M.median_val, "Q2"),
                      (M.q3_val, "Q3")], "Q4", op="<").alias("minutes_quartile"),
        X.case([
            (few, "Insufficient Minutes"),
            ((usg >= U.p90) & meaningful, "Heliocentric Option"),
            ((usg >= U.q3) & (mins >= M.q3_cat), "Primary Option"),
            ((usg >= U.median) & (mins >= M.median_cat), "Secondary Option"),
            ((usg >= U.q1) & meaningful, "Role Player"),
            (meaningful & (usg >= U.p5), "Connector/Specialist"),
            (mins >= M.p5, "Low Usage Player"),
        ], "Limited Role").alias("usage_tier"),
        X.tier(usg, [(U.q1, "Q1"), (U.median, "Q2"), (U.q3, "Q3")], "Q4", op="<")
        .alias("usage_quartile"),
        X.tier(bpm, [(B.p90, "Elite Impact"), (B.q3, "High Impact"), (B.median, "Positive Impact"),
                     (B.q1, "Neutral Impact"), (B.p5, "Negative Impact")], "Very Negative Impact",
               guards=[(few, "Insufficient Minutes")]).alias("impact_tier"),
        X.tier(bpm, [(B.q1, "Q1"), (B.median, "Q2"), (B.q3, "Q3")], "Q4", op="<")
        .alias("bpm_quartile"),
        X.tier(ts, [(0.68, "Elite"), (0.53, "Good"), (0.40, "Average")], "Below Average",
               guards=[(few, "Insufficient Minutes")]).alias("shooting_efficiency_tier"),
        (mins >= M.p90).alias("is_extreme_minutes"),
        (mins >= M.q3_cat).alias("is_starter_minutes"),
        ((mins >= M.q3_cat) & (mins < M.p90)).alias("is_normal_starter_minutes"),
        ((mins >= M.median_cat) & (mins < M.q3_cat)).alias("is_rotation_minutes"),
        ((mins >= M.q1_cat) & (mins < M.median_cat)).alias("is_bench_minutes"),
        meaningful.alias("is_meaningful_minutes"),
        (meaningful & (_z("ast_percent") >= 20) & (_z("trb_percent") >= 15)).alias("is_versatile"),
        (meaningful & ((_z("stl_percent") >= 2.5) | (_z("blk_percent") >= 4))
         & (_z("d_rtg") < 105)).alias("is_defensive_specialist"),
        (meaningful & (_z("three_p_ar") >= 0.4) & (_z("d_rtg") < 110)).alias("is_three_and_d"),
        (usg >= U.p90).alias("is_extreme_usage"),
        (usg >= U.q3).alias("is_high_usage"),
        ((usg >= U.q3) & (usg < U.p90)).alias("is_normal_high_usage"),
        (usg >= U.median).alias("is_above_average_usage"),
        ((usg >= U.q3) & (mins >= M.q3_cat)).alias("is_primary_offensive_player"),
        ((usg >= U.median) & (mins >= M.median_cat)).alias("is_significant_contributor"),
        (bpm >= B.p90).alias("is_elite_impact"),
        (bpm >= B.q3).alias("is_positive_impact"),
        ((bpm >= B.q3) & (bpm < B.p90)).alias("is_normal_positive_impact"),
        (bpm >= B.median).alias("is_above_average_impact"),
        (bpm <= B.p5).alias("is_very_negative_impact"),
        (meaningful & (mins < M.q3_cat) & (usg >= U.p5) & (usg < U.p90) & (bpm >= B.p5))
        .alias("is_standard_player"),
        (meaningful & (mins < M.p90) & (usg >= U.p5) & (bpm >= B.p5)).alias("is_core_rotation_player"),
        ((mins >= M.q3_cat) & (mins < M.p90) & (bpm >= B.median)).alias("is_quality_starter"),
        "created_at", "updated_at")


# -------------------------------------------------------------- M6
def stg_team_game_basic_stats(src_df: DataFrame) -> DataFrame:
    src = scan_live(src_df, required=("game_id", "team"))
    z = _z
    mp = z("mp", 240)
    two_m = z("fg") - z("three_p")
    two_a = z("fga") - z("three_pa")
    poss = z("fga") + F.lit(0.44) * z("fta") - z("orb") + z("tov")
    shots = z("fga") + F.lit(0.44) * z("fta") + z("tov")
    return src.select(
        "game_id", "team", mp.alias("minutes_played"),
        z("fg").alias("field_goals_made"), z("fga").alias("field_goals_attempted"),
        z("fg_percent").alias("field_goal_pct"),
        z("three_p").alias("three_pointers_made"), z("three_pa").alias("three_pointers_attempted"),
        z("three_p_percent").alias("three_point_pct"),
        z("ft").alias("free_throws_made"), z("fta").alias("free_throws_attempted"),
        z("ft_percent").alias("free_throw_pct"),
        z("orb").alias("offensive_rebounds"), z("drb").alias("defensive_rebounds"),
        z("trb").alias("total_rebounds"), z("ast").alias("assists"), z("stl").alias("steals"),
        z("blk").alias("blocks"), z("tov").alias("turnovers"), z("pf").alias("personal_fouls"),
        z("pts").alias("points"),
        two_m.alias("two_pointers_made"), two_a.alias("two_pointers_attempted"),
        X.ratio_or_zero(two_m, two_a).alias("two_point_pct"),
        poss.alias("possessions_estimate"),
        F.when(mp > 0, poss * F.lit(48.0) / (mp.cast("double") / F.lit(5.0)))
        .otherwise(F.lit(0.0)).alias("pace"),
        X.ratio_or_zero(z("fg") + F.lit(0.5) * z("three_p"), z("fga")).alias("effective_fg_pct"),
        X.ratio_or_zero(z("tov"), shots).alias("turnover_rate"),
        X.ratio_or_zero(z("orb"), z("orb") + z("drb")).alias("offensive_rebound_rate"),
        X.ratio_or_zero(z("fta"), z("fga")).alias("free_throw_rate"),
        X.ratio_or_zero(z("ast"), z("tov")).alias("ast_to_tov_ratio"),
        X.ratio_or_zero(z("pts"), poss).alias("points_per_possession"),
        X.ratio_or_zero(z("three_pa"), z("fga")).alias("three_point_rate"),
        "created_at", "updated_at")


# -------------------------------------------------------------- M7
def stg_team_game_adv_stats(src_df: DataFrame) -> DataFrame:
    src = scan_live(src_df, required=("game_id", "team"))
    z = _z
    return src.select(
        "game_id", "team", z("mp", 240).alias("minutes_played"),
        z("ts_percent").alias("true_shooting_pct"), z("efg_percent").alias("effective_fg_pct"),
        z("three_p_ar").alias("three_point_attempt_rate"), z("f_tr").alias("free_throw_rate"),
        z("orb_percent").alias("offensive_rebound_pct"), z("drb_percent").alias("defensive_rebound_pct"),
        z("trb_percent").alias("total_rebound_pct"), z("ast_percent").alias("assist_pct"),
        z("stl_percent").alias("steal_pct"), z("blk_percent").alias("block_pct"),
        z("tov_percent").alias("turnover_pct"), z("usg_percent", 100).alias("usage_pct"),
        z("o_rtg").alias("offensive_rating"), z("d_rtg").alias("defensive_rating"),
        (z("o_rtg") - z("d_rtg")).alias("net_rating"),
        X.tier(z("o_rtg"), [(115, "Elite Offense"), (110, "Good Offense"), (105, "Average Offense")],
               "Below Average Offense").alias("offensive_tier"),
        X.tier(z("d_rtg"), [(105, "Elite Defense"), (110, "Good Defense"), (115, "Average Defense")],
               "Below Average Defense", op="<=").alias("defensive_tier"),
        X.tier(z("three_p_ar"), [(0.4, "Three Point Heavy"), (0.3, "Balanced")],
               "Inside Focused").alias("shot_selection_style"),
        X.tier(z("ast_percent"), [(65, "High Ball Movement"), (55, "Average Ball Movement")],
               "Isolation Heavy").alias("ball_movement_style"),
        X.tier(z("orb_percent"), [(30, "Elite Offensive Rebounding"), (25, "Good Offensive Rebounding")],
               "Average Offensive Rebounding").alias("offensive_rebounding_tier"),
        X.tier(z("drb_percent"), [(80, "Elite Defensive Rebounding"), (75, "Good Defensive Rebounding")],
               "Average Defensive Rebounding").alias("defensive_rebounding_tier"),
        X.tier(z("tov_percent"), [(12, "Excellent Ball Security"), (15, "Good Ball Security")],
               "Poor Ball Security", op="<=").alias("ball_security_tier"),
        X.tier(z("stl_percent") + z("blk_percent"), [(20, "Very Active Defense"), (15, "Active Defense")],
               "Passive Defense").alias("defensive_activity"),
        "created_at", "updated_at")
