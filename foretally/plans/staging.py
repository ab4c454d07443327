"""Raw tables to typed staging frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import minutes_played

# Game states that count as finished.
FINAL_STATES = ["Final", "Final/OT", "Final/OT2"]

# Raw to staging names.
TEAM_STATS = {
    "points": "points", "assists": "assists", "rebounds_total": "rebounds", "steals": "steals", "blocks": "blocks",
    "turnovers": "turnovers", "field_goals_made": "fg_made", "field_goals_attempted": "fg_attempted",
    "three_pointers_made": "fg3_made", "three_pointers_attempted": "fg3_attempted",
    "free_throws_made": "ft_made", "free_throws_attempted": "ft_attempted",
}
TEAM_RATIOS = {"field_goal_pct": "fg_pct", "three_point_pct": "fg3_pct", "free_throw_pct": "ft_pct"}
PLAYER_STATS = {
    "points": "points", "assists": "assists", "rebounds_total": "rebounds",
    "rebounds_offensive": "rebounds_offensive", "rebounds_defensive": "rebounds_defensive",
    "steals": "steals", "blocks": "blocks", "turnovers": "turnovers", "fouls_personal": "fouls_personal",
    "fouls_technical": "fouls_technical", "field_goals_made": "fg_made", "field_goals_attempted": "fg_attempted",
    "three_pointers_made": "fg3_made", "three_pointers_attempted": "fg3_attempted",
    "free_throws_made": "ft_made", "free_throws_attempted": "ft_attempted", "plus_minus": "plus_minus",
    "points_fast_break": "points_fastbreak", "points_in_paint": "points_in_paint",
    "points_second_chance": "points_second_chance",
}


def _int0(c: str, alias: str):
    return F.coalesce(F.col(c).try_cast("int"), F.lit(0)).alias(alias)


def _dbl0(c: str, alias: str):
    return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(alias)


def _day(c: str):
    return F.try_to_date(F.substring(F.col(c).cast("string"), 1, 10)).alias("game_date")


def stg_games(raw: DataFrame) -> DataFrame:
    both = F.col("home_score").isNotNull() & F.col("away_score").isNotNull()
    return raw.select(
        "game_id", "game_status", _day("game_date"), "season", "season_type",
        F.col("home_team_id").try_cast("int").alias("home_team_id"), "home_team_name",
        F.col("away_team_id").try_cast("int").alias("away_team_id"), "away_team_name",
        F.col("home_score").try_cast("int").alias("home_score"),
        F.col("away_score").try_cast("int").alias("away_score"),
        F.col("venue").alias("arena_name"), "arena_city", "arena_state",
        F.col("winner_team_id").try_cast("int").alias("winner_team_id"),
        F.coalesce(F.col("game_status").like("%OT%"), F.lit(False)).alias("is_overtime"),
        (F.coalesce(F.col("game_status").isin(FINAL_STATES), F.lit(False)) | both).alias("is_completed"),
    )


def stg_team_boxscores(raw: DataFrame) -> DataFrame:
    return raw.select(
        "game_id", F.col("team_id").try_cast("int").alias("team_id"), _day("game_date"), "team_name", "team_city",
        "is_home",
        *[_int0(c, a) for c, a in TEAM_STATS.items()],
        *[_dbl0(c, a) for c, a in TEAM_RATIOS.items()],
    )


def stg_player_boxscores(raw: DataFrame) -> DataFrame:
    return raw.select(
        "game_id", F.col("player_id").try_cast("int").alias("player_id"), _day("game_date"), "player_name",
        F.col("team_id").try_cast("int").alias("team_id"), "is_home", "is_starter",
        minutes_played("minutes").alias("minutes_played"),
        *[_int0(c, a) for c, a in PLAYER_STATS.items()],
        *[_dbl0(c, a) for c, a in TEAM_RATIOS.items()],
    )


def stg_injuries(raw: DataFrame) -> DataFrame:
    return raw.select(
        "injury_id", F.col("capture_date").cast("date").alias("capture_date"), "player_name", "player_espn_id",
        "team_name", "team_abbrev", "status", "status_raw", "injury_details",
        F.col("captured_at").cast("timestamp").alias("captured_at"),
    )


def stg_teams(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("team_id").try_cast("int").alias("team_id"), "team_name", "team_abbreviation",
        F.col("city").alias("team_city"), "conference", "division",
    )
