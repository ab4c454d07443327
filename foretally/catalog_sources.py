"""Queries over the ingestion jobs.

The landed payloads (JSON documents, HTML pages, CSV rows) are derived from the
test tables with Spark, then read back by the ingestion functions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans.registry import shared_dir
from .plans.views import staging_from_star
from .sources import contracts, history, injury_pages, payloads, tables



def _stamp():
    return F.to_timestamp(F.lit("2024-01-01 00:00:00"))


def _stg(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return staging_from_star(spark, d)


#: Rows of one document or page on average, where a day or team has most of them.
DOCUMENT_ROWS = 500


def _dealt(df: DataFrame, by: str, ident: str) -> DataFrame:
    """Adds `_doc`: a day or team with more rows than a document holds becomes several documents."""
    most = df.groupBy(by).count().agg(F.max("count")).first()[0] or 0
    return df.withColumn("_doc", F.pmod(F.xxhash64(ident), F.lit(max(1, -(-most // DOCUMENT_ROWS)))))


def _side(s: str):
    t = F.col(f"{s}_team_id")
    return F.struct(t.cast("long").alias("teamId"), F.concat(F.lit("Name"), t).alias("teamName"), F.concat(F.lit("T"), t).alias("teamTricode"),
                    F.concat(F.lit("City"), t).alias("teamCity"), F.col(f"{s}_score").cast("long").alias("score")).alias(f"{s}Team")


def _game_struct():
    done = F.col("home_score").isNotNull()
    return F.struct(
        F.col("game_id").cast("string").alias("gameId"), F.when(done, 3).otherwise(1).alias("gameStatus"), F.col("game_status").alias("gameStatusText"),
        F.concat(F.col("game_date").cast("string"), F.lit("T00:00:00Z")).alias("gameDateEst"), F.lit("Arena").alias("arenaName"),
        F.lit(4).alias("period"), _side("home"), _side("away"))


def schedule_docs(g: DataFrame) -> DataFrame:
    """Schedule documents, of one day each."""
    by_day = _dealt(g, "game_date", "game_id").groupBy("game_date", "_doc").agg(F.collect_list(_game_struct()).alias("games"))
    day = F.struct(F.col("game_date").cast("string").alias("gameDate"), "games")
    return by_day.select(F.to_json(F.struct(F.struct(F.array(day).alias("gameDates")).alias("leagueSchedule"))).alias("payload"))


def src_games(spark, d):
    return payloads.games_from_schedule(schedule_docs(_stg(spark, d)["stg_games"]), _stamp()).drop("created_at")


def src_teams(spark, d):
    s = _stg(spark, d)
    league = s["stg_teams"].select(F.col("team_id").cast("long").alias("team_id"), "conference", "division")
    return payloads.teams_from_schedule(schedule_docs(s["stg_games"]), league, _stamp()).drop("created_at")


def src_todays_games(spark, d):
    by_day = _dealt(_stg(spark, d)["stg_games"], "game_date", "game_id").groupBy("game_date", "_doc").agg(F.collect_list(_game_struct()).alias("games"))
    docs = by_day.select(F.to_json(F.struct(F.struct(F.col("game_date").cast("string").alias("gameDate"), "games").alias("scoreboard"))).alias("payload"))
    return payloads.todays_games(docs, _stamp()).drop("created_at")


def src_players(spark, d):
    p = _stg(spark, d)["players"]
    row = F.array(F.col("player_id").cast("string"), F.lit("Player"), F.col("player_id").cast("string"), F.col("team_id").cast("string"),
                  F.col("team_abbreviation"), (F.col("player_id") % 3).cast("string"), (F.col("player_id") * 1.5).cast("string"))
    heads = F.array(*[F.lit(h) for h in ("PERSON_ID", "PLAYER_FIRST_NAME", "PLAYER_LAST_NAME", "TEAM_ID", "TEAM_ABBREVIATION", "ROSTER_STATUS", "PTS")])
    docs = _dealt(p, "team_id", "player_id").groupBy("team_id", "_doc").agg(F.collect_list(row).alias("rowSet")).select(
        F.to_json(F.struct(F.array(F.struct(heads.alias("headers"), "rowSet")).alias("resultSets"))).alias("payload"))
    return payloads.players_from_index(docs, _stamp()).drop("created_at")


def src_betting_odds(spark, d):
    g = _stg(spark, d)["stg_games"].select("game_id", "game_date")
    i = F.col("game_id")

    def out(kind, odds, line):
        return F.struct(F.lit(kind).alias("type"), odds.cast("double").alias("odds"), line.cast("double").alias("line"))

    two = F.array(out("home", 1 + i % 7 * 0.25, i % 9 - 4.5), out("away", 1 + i % 5 * 0.5, 4.5 - i % 9))
    total = F.array(out("over", 1 + i % 4 * 0.25, i % 30 + 200), out("under", 1 + i % 3 * 0.5, i % 30 + 200))
    books = lambda o: F.array(*[F.struct(F.lit(b).alias("name"), o.alias("outcomes")) for b in ("BookA", "BookB")])
    markets = F.array(F.struct(F.lit("2way").alias("name"), books(two).alias("books")), F.struct(F.lit("total").alias("name"), books(total).alias("books")))
    docs = _dealt(g, "game_date", "game_id").groupBy("game_date", "_doc").agg(F.collect_list(F.struct(i.cast("string").alias("gameId"), markets.alias("markets"))).alias("games"))
    return payloads.betting_odds(docs.select(F.to_json(F.struct("games")).alias("payload")), _stamp()).drop("captured_at")


def boxscore_docs(s: dict[str, DataFrame]) -> DataFrame:
    """One box-score document per game."""
    made, att = F.floor(F.col("points") / 3), F.floor(F.col("points") / 3) + F.col("assists")
    player = F.struct(
        F.col("player_id").cast("long").alias("personId"), F.concat(F.lit("Player "), F.col("player_id")).alias("name"),
        F.when(F.col("player_id") % 3 == 0, "1").otherwise("0").alias("starter"),
        F.struct("minutes", "points", "assists", F.col("rebounds").alias("reboundsTotal"), made.alias("fieldGoalsMade"), att.alias("fieldGoalsAttempted")).alias("statistics"))
    sides = s["stg_player_boxscores"].groupBy("game_id", "is_home").agg(F.collect_list(player).alias("players"), F.max("team_id").alias("team_id"), F.max("game_date").alias("game_date"))
    per = F.array(*[F.struct(F.lit(k).alias("period"), (F.col("team_id") + k * 10).cast("long").alias("score")) for k in (1, 2, 3, 4, 5)])
    team = F.struct(F.col("team_id").cast("long").alias("teamId"), F.concat(F.lit("Name"), F.col("team_id")).alias("teamName"), per.alias("periods"), "players")
    g = sides.groupBy("game_id").agg(F.max("game_date").alias("game_date"), F.max(F.when(F.col("is_home"), F.to_json(team))).alias("h"), F.max(F.when(~F.col("is_home"), F.to_json(team))).alias("a"))
    return g.select(F.concat(
        F.lit('{"game":{"gameId":"'), F.col("game_id").cast("string"), F.lit('","gameTimeUTC":"'), F.col("game_date").cast("string"), F.lit('T01:00:00Z","homeTeam":'),
        F.coalesce("h", F.lit("{}")), F.lit(',"awayTeam":'), F.coalesce("a", F.lit("{}")), F.lit("}}")).alias("payload"))


def src_boxscores(spark, d):
    return payloads.player_boxscores(boxscore_docs(_stg(spark, d)), _stamp()).drop("created_at")


def src_team_boxscores(spark, d):
    return payloads.team_boxscores(boxscore_docs(_stg(spark, d)), _stamp()).filter("team_id is not null").drop("created_at")


NAMES = {f"Team {i}": f"T{i}" for i in range(25)}


def _reports(s: dict[str, DataFrame]) -> DataFrame:
    return s["stg_injuries"].select("injury_id", "capture_date", "player_name", "team_abbrev", "status", F.concat(F.lit("Team "), F.substring("team_abbrev", 2, 3)).alias("team_name"))


def pages_by_team(s: dict[str, DataFrame]) -> DataFrame:
    """Pages of one day each, one titled table per team."""
    tr = F.concat(F.lit('<tr><td><a href="/player/_/id/'), F.col("injury_id"), F.lit('/x">'), F.col("player_name"), F.lit("</a></td><td>"), F.col("status"),
                  F.lit("</td><td>knee &amp; ankle "), F.col("injury_id"), F.lit("</td></tr>"))
    head = F.lit("<table><tr><th>NAME</th><th>STATUS</th><th>COMMENT</th></tr>")
    reports = _dealt(_reports(s), "capture_date", "injury_id")
    team = reports.groupBy("capture_date", "_doc", "team_name").agg(F.concat_ws("", F.collect_list(tr)).alias("rows"))
    sec = F.concat(F.lit('<div class="ResponsiveTable x"><div class="Table__Title">'), F.col("team_name"), F.lit("</div>"), head, F.col("rows"), F.lit("</table></div>"))
    return team.groupBy("capture_date", "_doc").agg(F.concat_ws("", F.collect_list(sec)).alias("html")).drop("_doc").withColumn("captured_at", _stamp())


def src_injuries_by_team(spark, d):
    return injury_pages.injuries_by_team(pages_by_team(_stg(spark, d)), NAMES).drop("captured_at")


def src_injuries_by_row(spark, d):
    tr = F.concat(F.lit("<tr class='injury'><td>"), F.col("player_name"), F.lit("</td><td>"), F.col("team_abbrev"), F.lit("</td><td>"), F.col("status"),
                  F.lit("</td><td>knee injury no "), F.col("injury_id"), F.lit("</td></tr>"))
    reports = _dealt(_reports(_stg(spark, d)), "capture_date", "injury_id")
    pages = reports.groupBy("capture_date", "_doc").agg(F.concat_ws("", F.lit("<table>"), F.concat_ws("", F.collect_list(tr)), F.lit("</table>")).alias("html")).drop("_doc")
    return injury_pages.injuries_by_row(pages.withColumn("captured_at", _stamp()), NAMES).drop("captured_at")


def src_injuries_past_day(spark, d):
    return injury_pages.injuries_on(pages_by_team(_stg(spark, d)), "2001-02-03", NAMES).drop("captured_at")


def src_page_tables(spark, d):
    """Reports on the given web pages: they hold no injury table, so each yields its marker."""
    p = spark.read.parquet(f"{d}/pages.parquet").select("html", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")).alias("capture_date"), _stamp().alias("captured_at"))
    return injury_pages.injuries_by_team(p).groupBy("capture_date", "team_abbrev", "status").agg(F.count(F.lit(1)).alias("n"))


def src_history_boxscores(spark, d):
    from pyspark.sql import Window

    b = _stg(spark, d)["stg_player_boxscores"]
    w = Window.partitionBy("game_id", "team_id").orderBy("player_id")
    rows = b.select(F.col("game_id").cast("string").alias("game_id"), F.col("game_date").cast("string").alias("game_date"), "team_id", "is_home",
                    (F.row_number().over(w) - 1).alias("row_no"), F.concat(F.lit(" Player "), "player_id").alias("Player"), F.concat(F.lit("3"), F.col("player_id") % 10, F.lit(":30")).alias("MP"),
                    F.col("points").cast("string").alias("PTS"), F.when(F.col("assists") > 0, F.col("assists").cast("string")).otherwise("-").alias("AST"), F.col("rebounds").alias("TRB"))
    names = b.select(F.concat(F.lit("Player "), "player_id").alias("player_name"), F.col("player_id").cast("long").alias("known_id")).filter("known_id % 2 = 0").distinct()
    return history.history_boxscores(rows, names, _stamp()).select(
        "game_id", "player_id", "game_date", "player_name", "team_id", "is_home", "is_starter", "minutes", "minutes_calculated", "points", "assists", "rebounds_total", "steals")


def src_synthetic_ids(spark, d):
    g = _stg(spark, d)["stg_games"]
    text = F.when(F.col("game_id") % 2 == 0, F.col("game_date").cast("string")).otherwise(F.date_format("game_date", "MM/dd/yyyy"))
    return g.select("game_id", history.synthetic_game_id(history.flexible_date(text), (F.col("game_id") % 100).cast("int")).alias("synthetic_id"),
                    history.history_team_id(F.when(F.col("game_id") % 2 == 0, "bos").otherwise("XXX")).alias("mapped_team_id"))


def src_bulk_player_stats(spark, d):
    s = _stg(spark, d)
    b = s["stg_player_boxscores"]
    rows = b.select(
        F.col("player_id").alias("personId"), F.col("game_id").alias("gameId"), F.concat(F.col("game_date").cast("string"), F.lit("T20:30:00-05:00")).alias("gameDateTimeEst"),
        F.lit("Player").alias("firstName"), F.col("player_id").cast("string").alias("lastName"),
        F.when(F.col("team_id") % 2 == 0, F.concat(F.lit("City"), "team_id")).otherwise("Elsewhere").alias("playerteamCity"), F.concat(F.lit("Name"), "team_id").alias("playerteamName"),
        F.col("is_home").cast("int").alias("home"), F.col("minutes_played").alias("numMinutes"), "points", "assists", F.col("rebounds").alias("reboundsTotal"))
    teams = s["stg_teams"].select("team_id", F.concat(F.lit("Name"), "team_id").alias("team_name"), "team_abbreviation", F.concat(F.lit("City"), "team_id").alias("city"))
    out = history.bulk_player_statistics(rows, teams, _stamp())
    return out.select("game_id", "player_id", "game_date", "player_name", "team_id", "is_home", "minutes", "minutes_calculated", "points", "assists", "rebounds_total", "steals")


def _transactions(s):
    r = _reports(s)
    m = F.col("injury_id") % 4
    return r.select(
        F.col("capture_date").cast("string").alias("Date"), F.when(F.col("injury_id") % 13 != 0, F.col("team_name")).alias("Team"),
        F.when(m.isin(0, 2), F.col("player_name")).alias("Acquired"), F.when(m.isin(1, 2), F.concat(F.col("player_name"), F.lit(" Jr"))).alias("Relinquished"),
        F.when(F.col("injury_id") % 5 == 0, "placed on IL").when(F.col("injury_id") % 5 == 1, "questionable, may be out").when(F.col("injury_id") % 5 == 2, "Doubtful").alias("Notes"))


def src_transactions(spark, d):
    return history.transactions_to_injuries(_transactions(_stg(spark, d)), _stamp(), True, NAMES).drop("captured_at", "player_espn_id")


def src_transactions_recent(spark, d):
    return history.transactions_to_injuries(_transactions(_stg(spark, d)), _stamp(), False, NAMES).drop("captured_at", "player_espn_id")


def src_mapped_csv(spark, d):
    g = _stg(spark, d)["stg_games"].select(F.col("game_id").alias("GAME_ID"), F.col("game_date").alias("GAME_DATE"), F.col("season").alias("SEASON"),
                                           F.col("home_team_id").alias("HOME_TEAM_ID"), F.col("away_team_id").alias("AWAY_TEAM_ID"), F.col("home_score").alias("HOME_SCORE"), F.col("away_score").alias("AWAY_SCORE"))
    return history.mapped_csv(g, "games", _stamp()).drop("created_at")


def src_csv_round_trip(spark, d):
    g = src_games(spark, d)
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    tables.export_csv(g, path)
    return tables.import_csv(spark, path, g.schema)


def src_games_from_boxscores(spark, d):
    s = _stg(spark, d)
    return history.games_from_boxscores(s["stg_player_boxscores"], s["stg_games"].filter("game_id % 3 = 0"))


def src_team_boxscores_from_players(spark, d):
    s = _stg(spark, d)
    box = s["stg_player_boxscores"].select("game_id", "game_date", "team_id", "is_home", "points", "assists", F.col("rebounds").alias("rebounds_total"),
                                           F.floor(F.col("points") / 3).alias("field_goals_made"), (F.floor(F.col("points") / 3) + F.col("assists")).alias("field_goals_attempted"))
    return history.team_boxscores_from_players(box, s["stg_team_boxscores"].filter("(game_id + team_id) % 3 = 0"))


def src_contract_nulls(spark, d):
    """Raw games against their contract: NULLs in required columns."""
    g = _stg(spark, d)["stg_games"].select("*", F.when(F.col("game_id") % 10 != 0, F.lit("Regular Season")).alias("season_type"), _stamp().alias("created_at"))
    return contracts.null_violations(contracts.conform(g, contracts.CONTRACTS["games"]), contracts.CONTRACTS["games"])


def stg_games_query(spark, d):
    from .plans import staging

    return staging.stg_games(src_games(spark, d))


def stg_players_query(spark, d):
    from .plans import staging

    return staging.stg_player_boxscores(src_boxscores(spark, d)).select("game_id", "player_id", "game_date", "player_name", "team_id", "is_home", "is_starter", "minutes_played",
                                                                         "points", "assists", "rebounds", "fg_made", "fg_attempted", "plus_minus", "points_fastbreak")


def stg_team_boxscores_query(spark, d):
    from .plans import staging

    return staging.stg_team_boxscores(src_team_boxscores(spark, d))


def stg_injuries_query(spark, d):
    from .plans import staging

    raw = injury_pages.injuries_by_team(pages_by_team(_stg(spark, d)), NAMES)
    return staging.stg_injuries(raw).drop("captured_at")


def stg_teams_query(spark, d):
    from .plans import staging

    return staging.stg_teams(src_teams(spark, d))


QUERIES = {
    **{f.__name__: f for f in (
        src_games, src_teams, src_todays_games, src_players, src_betting_odds, src_boxscores, src_team_boxscores, src_injuries_by_team, src_injuries_by_row,
        src_injuries_past_day, src_page_tables, src_history_boxscores, src_synthetic_ids, src_bulk_player_stats, src_transactions, src_transactions_recent,
        src_mapped_csv, src_csv_round_trip, src_games_from_boxscores, src_team_boxscores_from_players, src_contract_nulls)},
    "stg_games": stg_games_query, "stg_player_boxscores": stg_players_query, "stg_team_boxscores": stg_team_boxscores_query,
    "stg_injuries": stg_injuries_query, "stg_teams": stg_teams_query,
}
