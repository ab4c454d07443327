"""Landed JSON payloads to raw tables: schedule, scoreboard, players, odds, box scores.

Every function takes a frame with one document per row, so a season of landed
files is spread over the cluster; nothing is collected into one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up, nvl, ratio
from ..functions.text import full_name, season_label
from .contracts import CONTRACTS, conform

_SIDE = "struct<teamId:bigint,teamName:string,teamTricode:string,teamCity:string,score:bigint>"
_GAME = f"""struct<gameId:string,gameStatus:int,gameStatusText:string,gameDateEst:string,arenaName:string,arenaCity:string,
 arenaState:string,period:bigint,gameClock:string,homeTeam:{_SIDE},awayTeam:{_SIDE}>"""
SCHEDULE = f"struct<leagueSchedule:struct<gameDates:array<struct<gameDate:string,games:array<{_GAME}>>>>>"
SCOREBOARD = f"struct<scoreboard:struct<gameDate:string,games:array<{_GAME}>>>"
ODDS = """struct<games:array<struct<gameId:string,markets:array<struct<name:string,books:array<struct<name:string,
 outcomes:array<struct<type:string,odds:double,line:double>>>>>>>>>"""
INDEX = "struct<resultSets:array<struct<headers:array<string>,rowSet:array<array<string>>>>>"


def _parsed(payloads: DataFrame, schema: str) -> DataFrame:
    return payloads.select(F.from_json("payload", schema).alias("d"))


def _scheduled(payloads: DataFrame) -> DataFrame:
    return _parsed(payloads, SCHEDULE).select(F.explode("d.leagueSchedule.gameDates").alias("gd")).select(F.explode("gd.games").alias("g"))


def _winner() -> Column:
    """Set only for a finished game with unequal scores."""
    h, a = nvl("g.homeTeam.score", 0), nvl("g.awayTeam.score", 0)
    return F.when(nvl("g.gameStatus", 1) == 3, F.when(h > a, F.col("g.homeTeam.teamId")).when(a > h, F.col("g.awayTeam.teamId")))


def _game_columns(season: str | None, day: Column) -> list[Column]:
    label = F.lit(season) if season else season_label(day.cast("date"))
    return [
        F.col("g.gameId").alias("game_id"), day.alias("game_date"), label.alias("season"), F.lit("Regular Season").alias("season_type"),
        F.col("g.homeTeam.teamId").alias("home_team_id"), F.col("g.awayTeam.teamId").alias("away_team_id"),
        full_name("g.homeTeam.teamCity", "g.homeTeam.teamName").alias("home_team_name"),
        full_name("g.awayTeam.teamCity", "g.awayTeam.teamName").alias("away_team_name"),
        F.col("g.homeTeam.score").alias("home_score"), F.col("g.awayTeam.score").alias("away_score"),
        _winner().alias("winner_team_id"), nvl("g.gameStatusText", "Scheduled").alias("game_status"),
    ]


def games_from_schedule(payloads: DataFrame, created_at: Column, season: str | None = None) -> DataFrame:
    day = F.split_part(F.col("g.gameDateEst"), F.lit("T"), F.lit(1))
    out = _scheduled(payloads).select(
        *_game_columns(season, day), F.col("g.arenaName").alias("venue"), F.col("g.arenaCity").alias("arena_city"),
        F.col("g.arenaState").alias("arena_state"), created_at.alias("created_at"))
    return conform(out, CONTRACTS["games"])


def todays_games(payloads: DataFrame, created_at: Column, season: str | None = None) -> DataFrame:
    rows = _parsed(payloads, SCOREBOARD).select(F.col("d.scoreboard.gameDate").alias("day"), F.explode("d.scoreboard.games").alias("g"))
    out = rows.select(*_game_columns(season, F.col("day")), nvl("g.period", 0).alias("period"), nvl("g.gameClock", "").alias("game_clock"),
                      created_at.alias("created_at"))
    return conform(out, CONTRACTS["todays_games"])


def teams_from_schedule(payloads: DataFrame, league: DataFrame, created_at: Column) -> DataFrame:
    """Teams of the league found in a schedule; the earliest game of a team names it."""
    side = F.explode(F.array("g.homeTeam", "g.awayTeam"))
    rows = _scheduled(payloads).select(F.struct("g.gameDateEst", "g.gameId").alias("o"), side.alias("t"))
    first = rows.filter("t.teamId is not null").groupBy(F.col("t.teamId").alias("team_id")).agg(F.min_by("t", "o").alias("t"))
    out = first.join(league, "team_id").select(
        "team_id", F.col("t.teamName").alias("team_name"), F.col("t.teamTricode").alias("team_abbreviation"), F.col("t.teamCity").alias("city"),
        "conference", "division", F.lit(True).alias("is_active"), created_at.alias("created_at"))
    return conform(out, CONTRACTS["teams"])


# Player column -> header of the player index.
PLAYER_HEADERS = {
    "player_id": "PERSON_ID", "first_name": "PLAYER_FIRST_NAME", "last_name": "PLAYER_LAST_NAME", "player_slug": "PLAYER_SLUG",
    "team_id": "TEAM_ID", "team_name": "TEAM_NAME", "team_city": "TEAM_CITY", "team_abbreviation": "TEAM_ABBREVIATION",
    "jersey_number": "JERSEY_NUMBER", "position": "POSITION", "height": "HEIGHT", "weight": "WEIGHT", "college": "COLLEGE",
    "country": "COUNTRY", "draft_year": "DRAFT_YEAR", "draft_round": "DRAFT_ROUND", "draft_number": "DRAFT_NUMBER",
    "from_year": "FROM_YEAR", "to_year": "TO_YEAR", "career_pts": "PTS", "career_reb": "REB", "career_ast": "AST",
}


def players_from_index(payloads: DataFrame, created_at: Column, active_only: bool = True) -> DataFrame:
    """Header list plus row arrays to named columns; an absent header gives NULL."""
    rs = _parsed(payloads, INDEX).select(F.element_at("d.resultSets", 1).alias("s"))
    rows = rs.select("s.headers", F.explode("s.rowSet").alias("r")).select(F.map_from_arrays("headers", "r").alias("m"))
    if active_only:
        rows = rows.filter(F.col("m")["ROSTER_STATUS"].try_cast("double") == 1)
    out = rows.select(*[F.col("m")[h].alias(c) for c, h in PLAYER_HEADERS.items()], created_at.alias("created_at"))
    out = out.withColumn("player_name", F.concat_ws(" ", "first_name", "last_name"))
    return conform(out, CONTRACTS["players"])


def betting_odds(payloads: DataFrame, captured_at: Column) -> DataFrame:
    """Game -> market -> book; the outcome list becomes columns, a later outcome of a type wins."""
    g = _parsed(payloads, ODDS).select(F.explode("d.games").alias("g"))
    k = g.select("g.gameId", F.explode("g.markets").alias("m")).select("gameId", F.col("m.name").alias("market"), F.explode("m.books").alias("b"))

    def pick(kind: str, what: str) -> Column:
        of = F.filter("b.outcomes", lambda o: o.type == kind)
        return F.when(F.size(of) > 0, F.element_at(of, -1)[what])

    out = k.select(
        F.col("gameId").alias("game_id"), nvl("b.name", "unknown").alias("book_name"), nvl("market", "unknown").alias("market_type"),
        pick("home", "odds").alias("home_odds"), pick("away", "odds").alias("away_odds"), pick("home", "line").alias("home_line"),
        pick("away", "line").alias("away_line"), pick("over", "odds").alias("over_odds"), pick("under", "odds").alias("under_odds"),
        pick("over", "line").alias("total_line"), captured_at.alias("captured_at"))
    return conform(out, CONTRACTS["betting_odds"])


# Statistic column -> payload name.
PLAYER_STATS = {
    "points": "points", "assists": "assists", "rebounds_total": "reboundsTotal", "rebounds_offensive": "reboundsOffensive",
    "rebounds_defensive": "reboundsDefensive", "steals": "steals", "blocks": "blocks", "turnovers": "turnovers",
    "fouls_personal": "foulsPersonal", "fouls_technical": "foulsTechnical", "field_goals_made": "fieldGoalsMade",
    "field_goals_attempted": "fieldGoalsAttempted", "three_pointers_made": "threePointersMade",
    "three_pointers_attempted": "threePointersAttempted", "free_throws_made": "freeThrowsMade", "free_throws_attempted": "freeThrowsAttempted",
    "plus_minus": "plusMinusPoints", "points_fast_break": "pointsFastBreak", "points_in_paint": "pointsInThePaint",
    "points_second_chance": "pointsSecondChance",
}
PLAYER_PCTS = {"field_goal_pct": "fieldGoalsPercentage", "three_point_pct": "threePointersPercentage", "free_throw_pct": "freeThrowsPercentage"}
TEAM_SUMS = ("points", "assists", "rebounds_total", "steals", "blocks", "turnovers", "field_goals_made", "field_goals_attempted",
             "three_pointers_made", "three_pointers_attempted", "free_throws_made", "free_throws_attempted")
TEAM_PCTS = {"field_goal_pct": ("field_goals_made", "field_goals_attempted"), "three_point_pct": ("three_pointers_made", "three_pointers_attempted"),
             "free_throw_pct": ("free_throws_made", "free_throws_attempted")}

_STATISTICS = "struct<minutes:string,minutesCalculated:string," + ",".join(f"{n}:double" for n in [*PLAYER_STATS.values(), *PLAYER_PCTS.values()]) + ">"
_BOX_SIDE = f"""struct<teamId:bigint,teamName:string,teamCity:string,periods:array<struct<period:int,score:bigint>>,
 players:array<struct<personId:bigint,name:string,starter:string,statistics:{_STATISTICS}>>>"""
BOXSCORE = f"struct<game:struct<gameId:string,gameTimeUTC:string,homeTeam:{_BOX_SIDE},awayTeam:{_BOX_SIDE}>>"


def _box_sides(payloads: DataFrame) -> DataFrame:
    side = F.explode(F.array(F.struct(F.col("d.game.homeTeam").alias("t"), F.lit(True).alias("is_home")),
                             F.struct(F.col("d.game.awayTeam").alias("t"), F.lit(False).alias("is_home"))))
    day = F.split_part(nvl("d.game.gameTimeUTC", ""), F.lit("T"), F.lit(1))
    return _parsed(payloads, BOXSCORE).select(F.col("d.game.gameId").alias("game_id"), day.alias("game_date"), side.alias("s")).select(
        "game_id", "game_date", "s.*")


def player_boxscores(payloads: DataFrame, created_at: Column) -> DataFrame:
    rows = _box_sides(payloads).select("game_id", "game_date", F.col("t.teamId").alias("team_id"), "is_home", F.explode("t.players").alias("p"))
    st = "p.statistics"
    out = rows.select(
        "game_id", F.col("p.personId").alias("player_id"), "game_date", F.col("p.name").alias("player_name"), "team_id", "is_home",
        nvl(F.col("p.starter") == "1", False).alias("is_starter"), nvl(f"{st}.minutes", "0:00").alias("minutes"),
        nvl(f"{st}.minutesCalculated", "0:00").alias("minutes_calculated"),
        *[nvl(f"{st}.{n}", 0.0).alias(c) for c, n in {**PLAYER_STATS, **PLAYER_PCTS}.items()], created_at.alias("created_at"))
    return conform(out, CONTRACTS["boxscores"])


def team_boxscores(payloads: DataFrame, created_at: Column) -> DataFrame:
    """Team totals from the player list of the same document; no shuffle is needed."""
    rows = _box_sides(payloads)

    def total(name: str) -> Column:
        return F.aggregate(nvl_players(), F.lit(0.0), lambda acc, p: acc + F.coalesce(p["statistics"][PLAYER_STATS[name]], F.lit(0.0)))

    def nvl_players() -> Column:
        return F.coalesce(F.col("t.players"), F.array().cast(f"array<struct<personId:bigint,name:string,starter:string,statistics:{_STATISTICS}>>"))

    def quarter(k: int) -> Column:
        hit = F.filter("t.periods", lambda p: p.period == k)
        return F.when(F.size(hit) > 0, nvl(F.element_at(hit, -1)["score"], 0)).otherwise(0)

    out = rows.select("game_id", F.col("t.teamId").alias("team_id"), "game_date", F.col("t.teamName").alias("team_name"),
                      F.col("t.teamCity").alias("team_city"), "is_home", *[total(c).alias(c) for c in TEAM_SUMS],
                      *[quarter(k).alias(f"q{k}_points") for k in (1, 2, 3, 4)])
    pct = {c: half_up(nvl(ratio(100.0 * F.col(a), b), 0.0), 1) for c, (a, b) in TEAM_PCTS.items()}
    return conform(out.select("*", *[v.alias(c) for c, v in pct.items()], created_at.alias("created_at")), CONTRACTS["team_boxscores"])
