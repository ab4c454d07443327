"""What the published feature groups and mart hold, written out for the checks.

Names, defaults and formulas stand as text, apart from the plans under test, so a change in those shows.
"""

from __future__ import annotations

# Models of each group.
BASIC = """
    int_team_streaks int_team_streak_qual int_team_rest_days int_team_cum_fatigue int_team_weighted_momentum int_team_ctx_streaks
    int_team_recent_mom_exp
""".split()

OPPONENT = """
    int_team_opponent_quality int_team_opp_tier_perf int_team_opp_tier_ha int_team_perf_vs_opp_qual_rest int_team_perf_vs_similar_qual
    int_team_quality_adj_perf int_team_opp_similarity_perf int_team_recent_perf_wt_opp_qual
""".split()

CONTEXT = """
    int_team_home_road_perf int_team_home_away_opp_qual int_team_home_away_rest_perf int_team_clutch_perf int_team_blowout_perf
    int_team_cb_closeout_perf int_team_ot_perf int_team_outcome_qual int_team_upset_resistance int_team_favored_underdog_perf
    int_team_road_perf int_team_timing_perf
""".split()

TRENDS = """
    int_team_recent_form_trend int_team_mom_accel int_team_perf_consistency int_team_matchup_perf int_team_perf_vs_similar_mom
    int_team_perf_vs_rest_ctx int_team_perf_rest_adv int_team_perf_by_rest_combo int_team_matchup_compat int_team_perf_by_pace_ctx
""".split()

# Columns that come per side, and features with a home minus away difference.
QUARTER = """
    rolling_5_q4_ppg rolling_5_q4_net_rtg rolling_5_q4_win_pct rolling_10_q4_ppg rolling_10_q4_net_rtg rolling_10_q4_win_pct
    season_q4_win_pct_when_won_q4 q4_wins_count_season
""".split()

RACE = {
    "overall_rank": "playoff_rank",
    "is_in_playoff_position": "is_in_playoff_position",
    "games_back_from_cutoff": "games_back_from_cutoff",
    "win_pct_diff_from_cutoff": "win_pct_diff_from_cutoff",
    "is_close_to_cutoff": "is_close_to_cutoff",
    "is_fighting_for_playoff_spot": "is_fighting_for_playoff_spot",
}

DIVERGENCE = {
    "form_divergence_win_pct_5": "win_pct_divergence_5",
    "form_divergence_win_pct_10": "win_pct_divergence_10",
    "form_divergence_net_rtg_5": "net_rtg_divergence_5",
    "form_divergence_net_rtg_10": "net_rtg_divergence_10",
    "form_divergence_ppg_5": "ppg_divergence_5",
    "form_divergence_ppg_10": "ppg_divergence_10",
    "form_divergence_opp_ppg_5": "opp_ppg_divergence_5",
    "form_divergence_opp_ppg_10": "opp_ppg_divergence_10",
    "form_divergence_magnitude_win_pct_5": "form_divergence_magnitude_win_pct_5",
    "form_divergence_magnitude_win_pct_10": "form_divergence_magnitude_win_pct_10",
}

TREND_KEYS = """
    win_pct net_rtg ppg off_rtg efg_pct ts_pct opp_ppg def_rtg
""".split()

ACCELERATIONS = """
    win_pct_acceleration point_diff_acceleration ppg_acceleration defensive_acceleration net_rtg_acceleration
""".split()

OPPONENT_DIFFS = """
    win_pct_vs_strong_by_rest win_pct_vs_weak_by_rest win_pct_vs_similar_quality avg_point_diff_vs_similar_quality
    win_pct_vs_similar_opponents avg_point_diff_vs_similar_opponents
""".split()

CONTEXT_DIFFS = """
    blowout_win_pct blowout_avg_point_diff blowout_frequency comeback_win_pct closeout_win_pct comeback_avg_point_diff
    closeout_avg_point_diff win_pct_when_favored win_pct_when_underdog avg_point_diff_when_favored avg_point_diff_when_underdog upset_rate
""".split()

TREND_DIFFS = """
    win_pct_acceleration point_diff_acceleration ppg_acceleration defensive_acceleration net_rtg_acceleration win_pct_vs_similar_momentum
    avg_point_diff_vs_similar_momentum fast_pace_win_pct fast_pace_avg_point_diff slow_pace_win_pct slow_pace_avg_point_diff
""".split()

ALIASES = {
    "home_form_divergence_win_pct_5": "home_win_pct_divergence_5",
    "home_form_divergence_ppg_5": "home_ppg_divergence_5",
    "home_form_divergence_opp_ppg_5": "home_opp_ppg_divergence_5",
    "home_form_divergence_net_rtg_5": "home_net_rtg_divergence_5",
    "home_off_rtg_divergence_5": "home_net_rtg_divergence_5",
    "home_def_rtg_divergence_5": "home_net_rtg_divergence_5",
    "home_form_divergence_win_pct_10": "home_win_pct_divergence_10",
    "home_form_divergence_ppg_10": "home_ppg_divergence_10",
    "home_form_divergence_opp_ppg_10": "home_opp_ppg_divergence_10",
    "home_form_divergence_net_rtg_10": "home_net_rtg_divergence_10",
    "home_off_rtg_divergence_10": "home_net_rtg_divergence_10",
    "home_def_rtg_divergence_10": "home_net_rtg_divergence_10",
    "away_form_divergence_win_pct_5": "away_win_pct_divergence_5",
    "away_form_divergence_ppg_5": "away_ppg_divergence_5",
    "away_form_divergence_opp_ppg_5": "away_opp_ppg_divergence_5",
    "away_form_divergence_net_rtg_5": "away_net_rtg_divergence_5",
    "away_off_rtg_divergence_5": "away_net_rtg_divergence_5",
    "away_def_rtg_divergence_5": "away_net_rtg_divergence_5",
    "away_form_divergence_win_pct_10": "away_win_pct_divergence_10",
    "away_form_divergence_ppg_10": "away_ppg_divergence_10",
    "away_form_divergence_opp_ppg_10": "away_opp_ppg_divergence_10",
    "away_form_divergence_net_rtg_10": "away_net_rtg_divergence_10",
    "away_off_rtg_divergence_10": "away_net_rtg_divergence_10",
    "away_def_rtg_divergence_10": "away_net_rtg_divergence_10",
}

# Features whose default is a half; a leading home_ or away_ is left out.
HALF = """
    exp_weighted_win_pct_10 exp_weighted_win_pct_5 loss_streak_avg_opponent_quality win_streak_avg_opponent_quality h2h_win_pct
    h2h_win_pct_3 h2h_win_pct_5 vs_opponent_away_win_pct vs_opponent_home_win_pct avg_opponent_strength_10 avg_opponent_strength_5
    avg_opponent_strength_in_losses_10 avg_opponent_strength_in_losses_5 avg_opponent_strength_in_wins_10 avg_opponent_strength_in_wins_5
    current_game_similarity_score performance_vs_quality quality_adjusted_win_pct_10 quality_adjusted_win_pct_5 recent_opp_avg_win_pct
    sos_10_rolling sos_5_rolling sos_5_weighted weighted_win_pct_10 weighted_win_pct_5 win_pct_vs_opponent_tier
    win_pct_vs_opponent_tier_at_home win_pct_vs_opponent_tier_on_road win_pct_vs_similar_opponents win_pct_vs_similar_quality
    win_pct_vs_strong_by_rest win_pct_vs_weak_by_rest blowout_game_win_pct_10 blowout_game_win_pct_5 blowout_win_pct close_game_win_pct_10
    close_game_win_pct_5 closeout_win_pct clutch_win_pct comeback_win_pct early_season_win_pct favorite_win_pct home_win_pct
    late_season_win_pct mid_season_win_pct overtime_win_pct playoff_push_win_pct recent_road_win_pct_10 recent_road_win_pct_5 road_win_pct
    rolling_10_q4_win_pct rolling_5_q4_win_pct season_q4_win_pct_when_won_q4 win_pct_by_rest_bucket win_pct_vs_strong win_pct_vs_weak
    win_pct_when_favored win_pct_when_underdog fast_pace_win_pct net_rtg_compatibility_score off_vs_away_def_compatibility
    off_vs_home_def_compatibility pace_compatibility_score slow_pace_win_pct win_pct_by_rest_combination win_pct_moderate_vs_tired
    win_pct_vs_defensive win_pct_vs_fast_paced win_pct_vs_high_scoring win_pct_vs_similar_momentum win_pct_vs_similar_rest
    win_pct_vs_slow_paced win_pct_well_rested_vs_moderate win_pct_well_rested_vs_tired win_pct_with_rest_advantage
""".split()


def default(name: str, kind: str):
    """The published default of a feature of the groups: its SQL text."""
    base = name.removeprefix("home_") if name.startswith("home_") else name.removeprefix("away_")
    if kind == "BOOLEAN":
        return "false"
    if base in HALF or name in HALF:
        return "0.5"
    if base == "underdog_win_pct":
        return "0.3"
    if base == "playoff_rank":
        return "30"
    return "0.0" if kind == "DOUBLE" or kind.startswith("DECIMAL") else "0"


# The mart.
RETURNS = {
    "star_players_returning": 0,
    "key_players_returning": 0,
    "extended_returns": 0,
    "total_return_impact": 0.0,
    "max_days_since_return": None,
    "avg_days_since_return": None,
    "has_star_return": 0,
    "has_extended_return": 0,
}

ROLLING_DIFFS = """
    ppg win_pct fg_pct efg_pct ts_pct off_rtg def_rtg net_rtg pace tov_rate assist_rate steal_rate block_rate ppg_stddev opp_ppg_stddev
    ppg_cv opp_ppg_cv
""".split()

# Further differences: output name -> feature of both sides.
MART_DIFFS = {
    "sos_5_diff": "sos_5_rolling",
    "sos_10_diff": "sos_10_rolling",
    "sos_5_weighted_diff": "sos_5_weighted",
    "clutch_win_pct_diff": "clutch_win_pct",
    "clutch_avg_point_diff_diff": "clutch_avg_point_diff",
    "overtime_win_pct_diff": "overtime_win_pct",
    "overtime_avg_point_diff_diff": "overtime_avg_point_diff",
    "favorite_win_pct_diff": "favorite_win_pct",
    "underdog_win_pct_diff": "underdog_win_pct",
    "upset_resistance_score_diff": "upset_resistance_score",
    "win_pct_vs_strong_diff": "win_pct_vs_strong",
    "win_pct_vs_weak_diff": "win_pct_vs_weak",
    "win_pct_vs_fast_paced_diff": "win_pct_vs_fast_paced",
    "win_pct_vs_slow_paced_diff": "win_pct_vs_slow_paced",
    "win_pct_vs_high_scoring_diff": "win_pct_vs_high_scoring",
    "win_pct_vs_defensive_diff": "win_pct_vs_defensive",
    "playoff_rank_diff": "playoff_rank",
    "games_back_from_cutoff_diff": "games_back_from_cutoff",
    "win_pct_diff_from_cutoff_diff": "win_pct_diff_from_cutoff",
    "season_q4_win_pct_when_won_q4_diff": "season_q4_win_pct_when_won_q4",
    "weighted_win_streak_diff": "weighted_win_streak",
    "weighted_loss_streak_diff": "weighted_loss_streak",
    "win_streak_avg_opponent_quality_diff": "win_streak_avg_opponent_quality",
    "loss_streak_avg_opponent_quality_diff": "loss_streak_avg_opponent_quality",
    "playoff_position_diff": "is_in_playoff_position",
    "form_divergence_win_pct_diff_5": "form_divergence_win_pct_5",
    "form_divergence_win_pct_diff_10": "form_divergence_win_pct_10",
    "form_divergence_ppg_diff_5": "form_divergence_ppg_5",
    "form_divergence_ppg_diff_10": "form_divergence_ppg_10",
    "form_divergence_net_rtg_diff_5": "form_divergence_net_rtg_5",
    "form_divergence_net_rtg_diff_10": "form_divergence_net_rtg_10",
    "win_pct_divergence_diff_5": "win_pct_divergence_5",
    "win_pct_divergence_diff_10": "win_pct_divergence_10",
    "net_rtg_divergence_diff_5": "net_rtg_divergence_5",
    "net_rtg_divergence_diff_10": "net_rtg_divergence_10",
    "ppg_divergence_diff_5": "ppg_divergence_5",
    "ppg_divergence_diff_10": "ppg_divergence_10",
    "win_pct_trend_diff": "win_pct_trend",
    "net_rtg_trend_diff": "net_rtg_trend",
    "ppg_trend_diff": "ppg_trend",
    "off_rtg_trend_diff": "off_rtg_trend",
    "efg_pct_trend_diff": "efg_pct_trend",
    "ts_pct_trend_diff": "ts_pct_trend",
    "opp_ppg_trend_diff": "opp_ppg_trend",
    "def_rtg_trend_diff": "def_rtg_trend",
    "recent_win_pct_momentum_diff": "recent_win_pct_momentum",
    "recent_net_rtg_momentum_diff": "recent_net_rtg_momentum",
    "recent_ppg_momentum_diff": "recent_ppg_momentum",
    "recent_off_rtg_momentum_diff": "recent_off_rtg_momentum",
    "recent_efg_pct_momentum_diff": "recent_efg_pct_momentum",
    "recent_ts_pct_momentum_diff": "recent_ts_pct_momentum",
    "recent_opp_ppg_momentum_diff": "recent_opp_ppg_momentum",
    "recent_def_rtg_momentum_diff": "recent_def_rtg_momentum",
    "avg_margin_in_wins_diff_5": "avg_margin_in_wins_5",
    "avg_margin_in_wins_diff_10": "avg_margin_in_wins_10",
    "avg_margin_in_losses_diff_5": "avg_margin_in_losses_5",
    "avg_margin_in_losses_diff_10": "avg_margin_in_losses_10",
    "close_game_win_pct_diff_5": "close_game_win_pct_5",
    "close_game_win_pct_diff_10": "close_game_win_pct_10",
    "blowout_game_win_pct_diff_5": "blowout_game_win_pct_5",
    "blowout_game_win_pct_diff_10": "blowout_game_win_pct_10",
    "q4_ppg_diff_5": "rolling_5_q4_ppg",
    "q4_ppg_diff_10": "rolling_10_q4_ppg",
    "q4_net_rtg_diff_5": "rolling_5_q4_net_rtg",
    "q4_net_rtg_diff_10": "rolling_10_q4_net_rtg",
    "q4_win_pct_diff_5": "rolling_5_q4_win_pct",
    "q4_win_pct_diff_10": "rolling_10_q4_win_pct",
}

# Interactions, injury load, season clock, race flags, form against season.
MART_FORMULAS = {
    "injury_impact_x_form_diff": "injury_impact_diff * coalesce(home_rolling_10_win_pct - away_rolling_10_win_pct, cast(0 as double))",
    "away_injury_x_form": "-away_injury_impact_score * coalesce(away_rolling_10_win_pct, cast(0 as double))",
    "home_injury_x_form": "-home_injury_impact_score * coalesce(home_rolling_10_win_pct, cast(0 as double))",
    "injury_impact_x_rest_advantage": "injury_impact_diff * rest_advantage",
    "win_pct_diff_10_x_home_advantage": "coalesce(home_rolling_10_win_pct - away_rolling_10_win_pct, cast(0 as double)) * home_advantage",
    "net_rtg_diff_10_x_rest_advantage": "coalesce(home_rolling_10_net_rtg - away_rolling_10_net_rtg, cast(0 as double)) * rest_advantage",
    "net_rtg_diff_10_x_home_advantage": "coalesce(home_rolling_10_net_rtg - away_rolling_10_net_rtg, cast(0 as double)) * home_advantage",
    "off_rtg_diff_10_x_pace_diff_10": "coalesce(off_rtg_diff_10, cast(0 as double)) * coalesce(pace_diff_10, cast(0 as double))",
    "def_rtg_advantage_x_rest_advantage": "(coalesce(away_rolling_10_def_rtg, cast(0 as double)) - coalesce(home_rolling_10_def_rtg, cast(0 as double))) * rest_advantage",
    "rest_advantage_x_win_pct_diff_10": "coalesce(home_rolling_10_win_pct - away_rolling_10_win_pct, cast(0 as double)) * rest_advantage",
    "home_rest_days_x_home_win_pct_10": "home_rest_days * coalesce(home_rolling_10_win_pct, cast(0.5 as double))",
    "away_rest_days_x_away_win_pct_10": "away_rest_days * coalesce(away_rolling_10_win_pct, cast(0.5 as double))",
    "home_rest_days_x_home_sos_10": "home_rest_days * home_sos_10_rolling",
    "away_rest_days_x_away_sos_10": "away_rest_days * away_sos_10_rolling",
    "rest_advantage_x_sos_10_diff": "rest_advantage * (home_sos_10_rolling - away_sos_10_rolling)",
    "form_divergence_win_pct_diff_10_x_rest_advantage": "(home_form_divergence_win_pct_10 - away_form_divergence_win_pct_10) * rest_advantage",
    "home_btb_travel_x_win_pct_10": "home_back_to_back_with_travel * coalesce(home_rolling_10_win_pct, cast(0.5 as double))",
    "away_btb_travel_x_win_pct_10": "away_back_to_back_with_travel * coalesce(away_rolling_10_win_pct, cast(0.5 as double))",
    "home_btb_travel_x_rest_penalty": "home_back_to_back_with_travel * (cast(1 as double) / nullif(home_rest_days, 0))",
    "away_btb_travel_x_rest_penalty": "away_back_to_back_with_travel * (cast(1 as double) / nullif(away_rest_days, 0))",
    "momentum_score_diff_x_h2h_win_pct_3": "(home_momentum_score - away_momentum_score) * home_h2h_win_pct_3",
    "momentum_score_diff_x_h2h_win_pct_5": "(home_momentum_score - away_momentum_score) * home_h2h_win_pct_5",
    "home_momentum_x_h2h_win_pct_3": "home_momentum_score * home_h2h_win_pct_3",
    "home_momentum_x_h2h_win_pct_5": "home_momentum_score * home_h2h_win_pct_5",
    "away_momentum_x_h2h_win_pct_3": "away_momentum_score * (cast(1 as double) - home_h2h_win_pct_3)",
    "away_momentum_x_h2h_win_pct_5": "away_momentum_score * (cast(1 as double) - home_h2h_win_pct_5)",
    "weighted_momentum_diff_5_x_h2h_win_pct_5": "weighted_momentum_diff_5 * home_h2h_win_pct_5",
    "weighted_momentum_diff_10_x_h2h_win_pct_5": "weighted_momentum_diff_10 * home_h2h_win_pct_5",
    "home_win_streak_quality_x_away_opponent_quality": "home_win_streak_quality * coalesce(away_rolling_10_win_pct, cast(0.5 as double))",
    "away_win_streak_quality_x_home_opponent_quality": "away_win_streak_quality * coalesce(home_rolling_10_win_pct, cast(0.5 as double))",
    "win_streak_quality_diff_x_opponent_quality_diff": "win_streak_quality_diff * (coalesce(home_rolling_10_win_pct, cast(0.5 as double)) - coalesce(away_rolling_10_win_pct, cast(0.5 as double)))",
    "home_win_pct_vs_sos_10": "coalesce(home_rolling_10_win_pct, cast(0.5 as double)) - home_sos_10_rolling",
    "away_win_pct_vs_sos_10": "coalesce(away_rolling_10_win_pct, cast(0.5 as double)) - away_sos_10_rolling",
    "win_pct_vs_sos_10_diff": "(coalesce(home_rolling_10_win_pct, cast(0.5 as double)) - home_sos_10_rolling) - (coalesce(away_rolling_10_win_pct, cast(0.5 as double)) - away_sos_10_rolling)",
    "home_win_pct_vs_similar_rest_x_home_win_pct_10": "home_win_pct_vs_similar_rest * coalesce(home_rolling_10_win_pct, cast(0.5 as double))",
    "away_win_pct_vs_similar_rest_x_away_win_pct_10": "away_win_pct_vs_similar_rest * coalesce(away_rolling_10_win_pct, cast(0.5 as double))",
    "win_pct_vs_similar_rest_diff_x_win_pct_diff_10": "win_pct_vs_similar_rest_diff * coalesce(home_rolling_10_win_pct - away_rolling_10_win_pct, cast(0 as double))",
    "is_current_game_similar_rest_context_x_win_pct_diff_10": "cast(is_current_game_similar_rest_context as int) * coalesce(home_rolling_10_win_pct - away_rolling_10_win_pct, cast(0 as double))",
    "style_matchup_advantage_x_win_pct_diff_10": "style_matchup_advantage * coalesce(home_rolling_10_win_pct - away_rolling_10_win_pct, cast(0 as double))",
    "style_matchup_advantage_x_net_rtg_diff_10": "style_matchup_advantage * coalesce(home_rolling_10_net_rtg - away_rolling_10_net_rtg, cast(0 as double))",
    "pace_compatibility_x_win_pct_diff_10": "pace_compatibility_score * abs(coalesce(home_rolling_10_win_pct - away_rolling_10_win_pct, cast(0 as double)))",
    "home_off_vs_away_def_compatibility_x_win_pct_diff_10": "home_off_vs_away_def_compatibility * coalesce(home_rolling_10_win_pct - away_rolling_10_win_pct, cast(0 as double))",
    "away_off_vs_home_def_compatibility_x_win_pct_diff_10": "away_off_vs_home_def_compatibility * -(coalesce(home_rolling_10_win_pct - away_rolling_10_win_pct, cast(0 as double)))",
    "injury_advantage_home": "least(cast(3000 as double), greatest(-cast(3000 as double), -injury_impact_diff))",
    "home_injury_impact_ratio": "case when home_rolling_10_win_pct > 0 then home_injury_impact_score / (home_rolling_10_win_pct * 100) else cast(0 as double) end",
    "away_injury_impact_ratio": "case when away_rolling_10_win_pct > 0 then away_injury_impact_score / (away_rolling_10_win_pct * 100) else cast(0 as double) end",
    "home_injury_penalty_severe": "least(cast(2 as double), (case when home_rolling_10_win_pct > 0 then home_injury_impact_score / (home_rolling_10_win_pct * 100) else cast(0 as double) end) / cast(10 as double))",
    "away_injury_penalty_severe": "least(cast(2 as double), (case when away_rolling_10_win_pct > 0 then away_injury_impact_score / (away_rolling_10_win_pct * 100) else cast(0 as double) end) / cast(10 as double))",
    "home_injury_penalty_absolute": "least(cast(2 as double), home_injury_impact_score / cast(500 as double))",
    "away_injury_penalty_absolute": "least(cast(2 as double), away_injury_impact_score / cast(500 as double))",
    "days_since_season_start": "dayofyear(game_date) - 280",
    "season_progress": "least(greatest((dayofyear(game_date) - 280) / cast(180 as double), cast(0 as double)), cast(1 as double))",
    "is_late_season": "case when (dayofyear(game_date) - 280) / cast(180 as double) >= cast(0.7 as double) then 1 else 0 end",
    "is_playoff_race_game": "case when home_is_fighting_for_playoff_spot = 1 and away_is_fighting_for_playoff_spot = 1 then 1 else 0 end",
    "is_high_stakes_game": "case when home_is_close_to_cutoff = 1 or away_is_close_to_cutoff = 1 then 1 else 0 end",
    "home_form_vs_season_divergence_10": "coalesce(home_rolling_10_win_pct, cast(0.5 as double)) - coalesce(home_season_win_pct, cast(0.5 as double))",
    "away_form_vs_season_divergence_10": "coalesce(away_rolling_10_win_pct, cast(0.5 as double)) - coalesce(away_season_win_pct, cast(0.5 as double))",
    "form_vs_season_divergence_diff_10": "(coalesce(home_rolling_10_win_pct, cast(0.5 as double)) - coalesce(home_season_win_pct, cast(0.5 as double))) - (coalesce(away_rolling_10_win_pct, cast(0.5 as double)) - coalesce(away_season_win_pct, cast(0.5 as double)))",
    "home_net_rtg_vs_season_divergence_10": "coalesce(home_rolling_10_net_rtg, cast(0 as double)) - coalesce(home_season_point_diff, cast(0 as double))",
    "away_net_rtg_vs_season_divergence_10": "coalesce(away_rolling_10_net_rtg, cast(0 as double)) - coalesce(away_season_point_diff, cast(0 as double))",
    "net_rtg_vs_season_divergence_diff_10": "(coalesce(home_rolling_10_net_rtg, cast(0 as double)) - coalesce(home_season_point_diff, cast(0 as double))) - (coalesce(away_rolling_10_net_rtg, cast(0 as double)) - coalesce(away_season_point_diff, cast(0 as double)))",
}

# Fields of the game feature view by type.
VIEW_DOUBLES = """
    home_rolling_5_ppg away_rolling_5_ppg home_rolling_5_win_pct away_rolling_5_win_pct home_rolling_5_opp_ppg away_rolling_5_opp_ppg
    home_rolling_10_ppg away_rolling_10_ppg home_rolling_10_win_pct away_rolling_10_win_pct ppg_diff_5 win_pct_diff_5 ppg_diff_10
    win_pct_diff_10 home_season_win_pct away_season_win_pct season_win_pct_diff home_total_return_impact away_total_return_impact
    return_impact_diff home_injury_impact_score away_injury_impact_score injury_impact_diff injury_advantage_home injury_impact_x_form_diff
    away_injury_x_form home_injury_x_form home_injury_impact_ratio away_injury_impact_ratio home_momentum_score away_momentum_score
    home_form_divergence away_form_divergence home_h2h_win_pct home_recent_opp_avg_win_pct away_recent_opp_avg_win_pct
    home_performance_vs_quality away_performance_vs_quality home_home_win_pct away_road_win_pct home_advantage
""".split()

VIEW_INTS = """
    home_star_players_returning home_key_players_returning home_extended_returns home_max_days_since_return away_star_players_returning
    away_key_players_returning away_extended_returns away_max_days_since_return home_star_players_out home_key_players_out
    home_star_players_doubtful home_key_players_doubtful home_star_players_questionable home_injured_players_count away_star_players_out
    away_key_players_out away_star_players_doubtful away_key_players_doubtful away_star_players_questionable away_injured_players_count
    star_players_out_diff home_win_streak home_loss_streak away_win_streak away_loss_streak home_rest_days away_rest_days rest_advantage
    home_h2h_recent_wins
""".split()

VIEW_FLAGS = """
    home_has_key_injury away_has_key_injury home_back_to_back away_back_to_back
""".split()
