"""Historical CSV files and derived tables: box scores, games, injuries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import flag, nvl, ratio
from ..functions.text import duration_text, full_name, minutes_played, season_label
from .constants import HISTORY_TEAM_IDS
from .contracts import CONTRACTS, conform
from .injury_pages import abbreviation_map


def history_team_id(abbr: Column) -> Column:
    pairs = [F.lit(x) for kv in HISTORY_TEAM_IDS.items() for x in kv]
    return F.create_map(*pairs)[F.upper(abbr)]


def synthetic_game_id(day: Column, number: Column) -> Column:
    """`002` + season year + month + day + `0` + two-digit number of the game that day.

    The season year is that of the October before the game.
    """
    year = F.when(F.month(day) >= 10, F.year(day)).otherwise(F.year(day) - 1)
    return F.concat(F.lit("002"), F.lpad(F.pmod(year, F.lit(100)).cast("string"), 2, "0"), F.date_format(day, "MMdd"), F.lit("0"),
                    F.lpad(number.cast("string"), 2, "0"))


def flexible_date(text: Column) -> Column:
    """`2023-10-24` or `10/24/2023`; anything else is NULL."""
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "M/d/yyyy"))


# Statistic -> header names it may have, in order of preference.
STAT_HEADERS = {
    "points": ("PTS", "Points", "points"), "assists": ("AST", "Assists", "assists"), "rebounds_total": ("TRB", "Rebounds", "rebounds_total"),
    "rebounds_offensive": ("ORB", "Offensive Rebounds", "rebounds_offensive"), "rebounds_defensive": ("DRB", "Defensive Rebounds", "rebounds_defensive"),
    "steals": ("STL", "Steals", "steals"), "blocks": ("BLK", "Blocks", "blocks"), "turnovers": ("TOV", "TO", "Turnovers", "turnovers"),
    "fouls_personal": ("PF", "Fouls", "fouls_personal"), "field_goals_made": ("FG", "FGM", "Field Goals Made", "field_goals_made"),
    "field_goals_attempted": ("FGA", "Field Goals Attempted", "field_goals_attempted"), "field_goal_pct": ("FG%", "FG_PCT", "Field Goal %", "field_goal_pct"),
    "three_pointers_made": ("3P", "3PM", "Three Pointers Made", "three_pointers_made"),
    "three_pointers_attempted": ("3PA", "Three Pointers Attempted", "three_pointers_attempted"),
    "three_point_pct": ("3P%", "3P_PCT", "Three Point %", "three_point_pct"), "free_throws_made": ("FT", "FTM", "Free Throws Made", "free_throws_made"),
    "free_throws_attempted": ("FTA", "Free Throws Attempted", "free_throws_attempted"), "free_throw_pct": ("FT%", "FT_PCT", "Free Throw %", "free_throw_pct"),
    "plus_minus": ("+/-", "Plus/Minus", "plus_minus"),
}
NAME_HEADERS, MINUTE_HEADERS = ("PLAYER", "Name", "name", "Player"), ("MP", "Min", "MIN", "minutes")


def _first_of(df: DataFrame, names: tuple[str, ...], kind: str) -> Column:
    have = [F.col(f"`{n}`") for n in names if n in df.columns]
    cast = [F.nullif(F.trim(c.cast("string")), F.lit("")) for c in have]
    if kind == "double":
        cast = [c.try_cast("double") for c in cast]
    return F.coalesce(*cast) if cast else F.lit(None).cast(kind)


def history_boxscores(rows: DataFrame, names: DataFrame, created_at: Column, row_no: str = "row_no") -> DataFrame:
    """Box-score CSV rows (with game_id, game_date, team_id, is_home, row number) to raw rows.

    Total lines go; the id comes from the name table (player_name, known_id), else
    from a hash of the name; the first five rows of a side are its starters.
    """
    name = _first_of(rows, NAME_HEADERS, "string")
    mp = _first_of(rows, MINUTE_HEADERS, "string")
    r = rows.withColumn("player_name", name).withColumn("_mp", mp)
    r = r.filter(F.col("player_name").isNotNull() & ~F.col("player_name").isin("Team Totals", "Reserves"))
    r = r.join(names.select("player_name", "known_id"), "player_name", "left")
    hashed = F.conv(F.substring(F.md5("player_name"), 1, 8), 16, 10).cast("long") % 1_000_000_000
    mins = minutes_played("_mp")
    out = r.select(
        "game_id", F.coalesce("known_id", hashed).alias("player_id"), "game_date", "player_name", "team_id", "is_home",
        (F.col(row_no) < 5).alias("is_starter"), nvl("_mp", "0:00").alias("minutes"),
        F.when(mins > 0, F.concat(F.floor(mins * 60).cast("string"), F.lit(":00"))).otherwise("0:00").alias("minutes_calculated"),
        *[nvl(_first_of(r, h, "double"), 0.0).alias(c) for c, h in STAT_HEADERS.items()],
        *[F.lit(0).alias(c) for c in ("fouls_technical", "points_fast_break", "points_in_paint", "points_second_chance")],
        created_at.alias("created_at"))
    return conform(out, CONTRACTS["boxscores"])


# Column of the bulk statistics file -> raw column.
BULK_STATS = {
    "points": "points", "assists": "assists", "reboundsTotal": "rebounds_total", "reboundsOffensive": "rebounds_offensive",
    "reboundsDefensive": "rebounds_defensive", "steals": "steals", "blocks": "blocks", "turnovers": "turnovers", "foulsPersonal": "fouls_personal",
    "fieldGoalsMade": "field_goals_made", "fieldGoalsAttempted": "field_goals_attempted", "fieldGoalsPercentage": "field_goal_pct",
    "threePointersMade": "three_pointers_made", "threePointersAttempted": "three_pointers_attempted", "threePointersPercentage": "three_point_pct",
    "freeThrowsMade": "free_throws_made", "freeThrowsAttempted": "free_throws_attempted", "freeThrowsPercentage": "free_throw_pct",
    "plusMinusPoints": "plus_minus",
}


def team_names(teams: DataFrame) -> DataFrame:
    """(name, team_id): short name, abbreviation, city + name, and last word of the name."""
    n = teams.select("team_id", F.explode(F.array_distinct(F.array(
        F.col("team_name"), F.col("team_abbreviation"), full_name("city", "team_name"), F.element_at(F.split("team_name", " "), -1)))).alias("name"))
    return n.filter("name <> ''").groupBy("name").agg(F.max("team_id").alias("team_id"))


def bulk_player_statistics(rows: DataFrame, teams: DataFrame, created_at: Column, load_id: str = "bulk") -> DataFrame:
    """Bulk player statistics file to raw box-score rows with load columns."""
    names = team_names(teams)
    r = rows.withColumn("_full", full_name("playerteamCity", "playerteamName"))
    r = r.join(names.withColumnsRenamed({"name": "_full", "team_id": "_a"}), "_full", "left")
    r = r.join(names.withColumnsRenamed({"name": "playerteamName", "team_id": "_b"}), "playerteamName", "left")
    minutes = nvl(F.col("numMinutes").try_cast("double"), 0.0)
    out = r.select(
        F.col("gameId").cast("string").alias("game_id"), F.col("personId").cast("long").alias("player_id"),
        F.to_utc_timestamp(F.try_to_timestamp("gameDateTimeEst"), F.current_timezone()).cast("date").cast("string").alias("game_date"),
        full_name("firstName", "lastName").alias("player_name"), F.coalesce("_a", "_b").alias("team_id"), F.col("home").cast("boolean").alias("is_home"),
        minutes.alias("minutes"), F.when(minutes > 0, duration_text(minutes)).alias("minutes_calculated"),
        *[F.col(c).alias(a) for c, a in BULK_STATS.items() if c in rows.columns], created_at.alias("created_at"))
    out = conform(out, CONTRACTS["boxscores"])
    return out.withColumn("_dlt_load_id", F.lit(load_id)).withColumn("_dlt_id", F.sha2(F.concat_ws("|", "game_id", "player_id"), 256))


# Column names of the generic CSV exports.
MAPPINGS = {
    "boxscores": {
        "GAME_ID": "game_id", "PLAYER_ID": "player_id", "GAME_DATE": "game_date", "PLAYER_NAME": "player_name", "TEAM_ID": "team_id",
        "IS_HOME": "is_home", "IS_STARTER": "is_starter", "MIN": "minutes", "PTS": "points", "AST": "assists", "REB": "rebounds_total",
        "OREB": "rebounds_offensive", "DREB": "rebounds_defensive", "STL": "steals", "BLK": "blocks", "TOV": "turnovers", "PF": "fouls_personal",
        "FGM": "field_goals_made", "FGA": "field_goals_attempted", "FG_PCT": "field_goal_pct", "FG3M": "three_pointers_made",
        "FG3A": "three_pointers_attempted", "FG3_PCT": "three_point_pct", "FTM": "free_throws_made", "FTA": "free_throws_attempted",
        "FT_PCT": "free_throw_pct", "PLUS_MINUS": "plus_minus"},
    "games": {"GAME_ID": "game_id", "GAME_DATE": "game_date", "SEASON": "season", "HOME_TEAM_ID": "home_team_id", "AWAY_TEAM_ID": "away_team_id",
              "HOME_SCORE": "home_score", "AWAY_SCORE": "away_score"},
}
MAPPED_DEFAULTS = {"games": {"season_type": "Regular Season", "game_status": "Final"}, "boxscores": {}}


def mapped_csv(rows: DataFrame, table: str, created_at: Column) -> DataFrame:
    """Rename by mapping, fill constant defaults, NULL for the rest of the contract."""
    out = rows.withColumnsRenamed(MAPPINGS[table])
    for c, v in MAPPED_DEFAULTS[table].items():
        out = out.withColumn(c, nvl(c, v) if c in out.columns else F.lit(v))
    return conform(out.withColumn("created_at", created_at), CONTRACTS[table])


def transactions_to_injuries(rows: DataFrame, captured_at: Column, placed_is_out: bool = True, names: dict[str, str] | None = None) -> DataFrame:
    """Transaction log to injury rows in one pass: one row for who left, one for who came back.

    `placed_is_out` reads "out" and "placed on" before the other words; without
    it the words doubtful, questionable and probable come first. The two styles
    also differ in ids and texts, as the two log exports do.
    """
    day = F.coalesce(flexible_date(F.col("Date")), F.try_to_date("Date"))
    notes, low = nvl("Notes", ""), F.lower(nvl("Notes", ""))
    team, ab = F.trim("Team"), nvl(abbreviation_map(names)[F.trim("Team")], "UNK")
    if placed_is_out:
        status = F.when(low.contains("out") | low.contains("placed on"), "Out")
    else:
        status = F.when(F.lit(False), "Out")
    for word, s in (("doubtful", "Doubtful"), ("questionable", "Questionable"), ("probable", "Probable")):
        status = status.when(low.contains(word), s)
    status = status.otherwise("Out")

    def record(who: str, st: Column, raw: Column, details: Column, suffix: str) -> Column:
        name = F.trim(who)
        key = F.concat_ws("_", day.cast("string"), team if placed_is_out else ab, F.replace(name, F.lit(" "), F.lit("_")))
        return F.when(nvl(name, "") != "", F.struct(
            F.concat(key, F.lit(suffix)).alias("injury_id"), name.alias("player_name"), st.alias("status"), raw.alias("status_raw"),
            details.alias("injury_details")))

    if placed_is_out:
        left = record("Relinquished", status, status, notes, "")
        back = record("Acquired", F.lit("Active"), F.lit("Active"), F.concat(F.lit("Returned from injury: "), notes), "_return")
    else:
        left = record("Relinquished", status, notes, notes, "_OUT")
        back = record("Acquired", F.lit("Active"), F.lit("Returned from injury list"), notes, "_ACTIVE")
    out = rows.filter(F.col("Team").isNotNull()).select(
        day.alias("capture_date"), team.alias("team_name"), ab.alias("team_abbrev"), captured_at.alias("captured_at"),
        F.explode(F.filter(F.array(left, back), lambda x: x.isNotNull())).alias("r"))
    return conform(out.filter("capture_date is not null").select("*", "r.*"), CONTRACTS["injuries"])


def games_from_boxscores(box: DataFrame, known: DataFrame) -> DataFrame:
    """Games missing from `known`, with scores summed from player rows; both sides must be there."""
    r = box.filter("game_date is not null").join(known.select("game_id"), "game_id", "left_anti")
    home = F.col("is_home")
    g = r.groupBy("game_id", "game_date").agg(
        F.max(F.when(home, F.col("team_id"))).alias("home_team_id"), F.max(F.when(~home, F.col("team_id"))).alias("away_team_id"),
        F.sum(F.when(home, F.col("points")).otherwise(0)).cast("int").alias("home_score"),
        F.sum(F.when(~home, F.col("points")).otherwise(0)).cast("int").alias("away_score"))
    g = g.filter("home_team_id is not null and away_team_id is not null")
    return g.select(
        "game_id", "game_date", season_label(F.col("game_date").cast("date")).alias("season"), F.lit("Regular Season").alias("season_type"),
        "home_team_id", "away_team_id", "home_score", "away_score",
        F.when(F.col("home_score") > F.col("away_score"), F.col("home_team_id")).otherwise(F.col("away_team_id")).alias("winner_team_id"))


SUMMED = ("points", "assists", "rebounds_total", "steals", "blocks", "turnovers", "field_goals_made", "field_goals_attempted",
          "three_pointers_made", "three_pointers_attempted", "free_throws_made", "free_throws_attempted")


def team_boxscores_from_players(box: DataFrame, known: DataFrame) -> DataFrame:
    """Team rows missing from `known`, summed from player rows; shooting shares between 0 and 1."""
    r = box.filter("game_date is not null and team_id is not null").join(known.select("game_id", "team_id"), ["game_id", "team_id"], "left_anti")
    g = r.groupBy("game_id", "game_date", "team_id", "is_home").agg(*[F.sum(c).cast("int").alias(c) for c in SUMMED if c in box.columns])
    shares = {"field_goal_pct": ("field_goals_made", "field_goals_attempted"), "three_point_pct": ("three_pointers_made", "three_pointers_attempted"),
              "free_throw_pct": ("free_throws_made", "free_throws_attempted")}
    return g.filter("points is not null").select("*", *[
        nvl(ratio(a, b), 0.0).alias(c) for c, (a, b) in shares.items() if a in g.columns and b in g.columns])
