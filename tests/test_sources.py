"""Ingestion on hand-written payloads, pages and logs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from foretally.quality import rules
from foretally.sources import contracts, history, injury_pages, payloads



def stamp():
    return F.lit("2024-01-01").cast("timestamp")


def docs(spark, *objs):
    return spark.createDataFrame([(json.dumps(o),) for o in objs], "payload string")


def side(i, score, name="Hawks"):
    return {"teamId": i, "teamName": name, "teamTricode": "X", "teamCity": "Town", "score": score}


def test_schedule(spark):
    g = lambda i, st, h, a: {"gameId": str(i), "gameStatus": st, "gameDateEst": "2024-10-05T00:00:00Z", "homeTeam": h, "awayTeam": a}
    d = docs(spark, {"leagueSchedule": {"gameDates": [{"games": [g(1, 3, side(10, 5), side(11, 4)), g(2, 1, side(10, 9), side(99, 1))]}, {"games": [g(3, 3, side(11, 2), side(10, 2))]}]}})
    got = {r.game_id: r for r in payloads.games_from_schedule(d, stamp()).collect()}
    assert (got["1"].winner_team_id, got["2"].winner_team_id, got["3"].winner_team_id) == (10, None, None)
    assert (got["1"].game_date, got["1"].season, got["1"].home_team_name, got["1"].game_status) == ("2024-10-05", "2024-25", "Town Hawks", "Scheduled")
    league = spark.createDataFrame([(10, "East", "A"), (11, "West", "B")], "team_id long, conference string, division string")
    assert sorted(r.team_id for r in payloads.teams_from_schedule(d, league, stamp()).collect()) == [10, 11]


def test_players_with_missing_header(spark):
    d = docs(spark, {"resultSets": [{"headers": ["PERSON_ID", "PLAYER_FIRST_NAME", "PLAYER_LAST_NAME", "TEAM_ID", "ROSTER_STATUS"], "rowSet": [[1, "A", "B", 7, 1], [2, "C", "D", 7, 0]]}]})
    got = payloads.players_from_index(d, stamp()).collect()
    assert [(r.player_id, r.player_name, r.college) for r in got] == [(1, "A B", None)]
    assert payloads.players_from_index(d, stamp(), active_only=False).count() == 2


def test_odds_with_missing_outcome(spark):
    d = docs(spark, {"games": [{"gameId": "1", "markets": [{"name": "2way", "books": [{"name": "B", "outcomes": [{"type": "home", "odds": 1.5, "line": None}]}]}]}]})
    r = payloads.betting_odds(d, stamp()).collect()[0]
    assert (r.home_odds, r.away_odds, r.total_line) == (1.5, None, None)


def test_team_totals_with_overtime_period(spark):
    p = lambda pts, fgm, fga: {"personId": pts, "name": "n", "starter": "1", "statistics": {"points": pts, "fieldGoalsMade": fgm, "fieldGoalsAttempted": fga}}
    team = {"teamId": 1, "periods": [{"period": k, "score": 20 + k} for k in (1, 2, 3, 4, 5)], "players": [p(10, 1, 3), p(5, 2, 4)]}
    d = docs(spark, {"game": {"gameId": "9", "gameTimeUTC": "2024-01-02T01:00:00Z", "homeTeam": team, "awayTeam": {"teamId": 2, "players": []}}})
    got = {r.team_id: r for r in payloads.team_boxscores(d, stamp()).collect()}
    assert (got[1].points, got[1].field_goal_pct, got[1].q4_points, got[1].three_point_pct) == (15, 42.9, 24, 0.0)
    assert (got[2].points, got[2].q1_points) == (0, 0)


def test_injury_page_and_marker(spark):
    html = ('<div class="ResponsiveTable"><div class="Table__Title">Boston Celtics</div><table><tr><th>N</th><th>S</th><th>C</th></tr>'
            '<tr><td><a href="/x/id/42/y">Al Ho</a></td><td>Day-To-Day</td><td>knee</td></tr></table></div>'
            '<div class="ResponsiveTable"><div class="Table__Title">Nobody</div><table><tr><td>Bo</td><td>Out indefinitely</td><td>x</td></tr></table></div>')
    pages = spark.createDataFrame([(html, dt.date(2024, 1, 1)), ("<p>none</p>", dt.date(2024, 1, 2))], "html string, capture_date date").withColumn("captured_at", stamp())
    got = sorted((r.injury_id, r.player_espn_id, r.team_abbrev, r.status) for r in injury_pages.injuries_by_team(pages).collect())
    assert got == [("2024-01-01_BOS_Al_Ho", "42", "BOS", "Day-to-Day"), ("2024-01-01_UNK_Bo", None, "UNK", "Out"), ("2024-01-02_NO_INJURIES", None, "N/A", "N/A")]


def test_transactions(spark):
    rows = [("2024-01-01", "Miami Heat", "A B", None, "returned"), ("2024-01-01", "Miami Heat", None, "C D", "doubtful"), ("2024-01-01", "Miami Heat", "E", "F", None), ("2024-01-01", None, "X", "Y", "")]
    df = spark.createDataFrame(rows, "Date string, Team string, Acquired string, Relinquished string, Notes string")
    got = sorted((r.injury_id, r.status) for r in history.transactions_to_injuries(df, stamp(), placed_is_out=False).collect())
    assert got == [("2024-01-01_MIA_A_B_ACTIVE", "Active"), ("2024-01-01_MIA_C_D_OUT", "Doubtful"), ("2024-01-01_MIA_E_ACTIVE", "Active"), ("2024-01-01_MIA_F_OUT", "Out")]


def test_contract_projection(spark):
    c = contracts.from_mapping({"name": "t", "columns": [{"name": "a", "type": "integer", "primary_key": True}, {"name": "b", "type": "date"}]})
    assert c.key == ("a",) and not c.schema["a"].nullable
    df = spark.createDataFrame([("1", "2024-01-01", "z"), ("x", "bad", "z")], "a string, b string, c string")
    assert contracts.conform(df, c).columns == ["a", "b"]
    assert contracts.conform(df, c, strict=False).columns == ["a", "b", "c"]
    assert contracts.null_violations(contracts.conform(df, c), c).collect()[0].violations == 1
    assert {"boxscores": 33, "players": 24, "team_boxscores": 26, "injuries": 10}.items() <= {k: len(v.schema) for k, v in contracts.CONTRACTS.items()}.items()


def test_gate(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    res = rules.check(df, [rules.Rule("a_set", "not_null", ("a",))])
    with pytest.raises(rules.QualityError, match="a_set: 1"):
        rules.gate(res)
    assert rules.gate(res, fail_on_error=False).count() == 1


def test_streamed_upsert_equals_batch(spark, tmp_path):
    from foretally.operators.merge import upsert
    from foretally.streaming.ingest import latest, stream_into

    schema = "k int, v string, n int"
    first = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], schema)
    second = spark.createDataFrame([(2, "x", 1), (3, "c", 1), (3, "d", 2)], schema)
    src, dst, ck = (str(tmp_path / p) for p in ("src", "dst", "ck"))
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(src)
        stream_into(spark, src, first.schema, dst, ck, ["k"], ["n"]).awaitTermination()
    got = sorted((r.k, r.v) for r in latest(spark, dst, first.schema).collect())
    assert got == sorted((r.k, r.v) for r in upsert(first, second, ["k"], ["n"]).collect())
