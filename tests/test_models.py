"""Model invariants on the smallest test tables and on hand-written games."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from foretally.incremental import bundle, chunks, run_interval, schema_diff
from foretally.plans import assembly, context, core, mart, players, trends  # noqa: F401
from foretally.plans.registry import Models
from foretally.plans.views import staging_from_star

from .conftest import SF

CUT = "1998-06-01"
HISTORY = ["int_team_streaks", "int_team_rest_days", "int_team_h2h_stats", "int_team_clutch_perf", "int_team_perf_after_wl", "int_team_weighted_momentum"]


@pytest.fixture(scope="module")
def inputs(spark):
    return staging_from_star(spark, SF)


@pytest.fixture(scope="module")
def whole(spark, inputs):
    return Models(spark, inputs)


@pytest.fixture(scope="module")
def early(spark, inputs):
    return Models(spark, inputs, end=CUT)


def as_rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect())))


@pytest.mark.parametrize("name", HISTORY)
def test_later_games_do_not_change_earlier_rows(whole, early, name):
    full, part = whole[name], early[name]
    if "game_date" not in full.columns:
        days = whole.games.select("game_id", "game_date")
        full, part = full.join(days, "game_id"), part.join(days, "game_id")
    assert as_rows(part) == as_rows(full.filter(F.col("game_date") < CUT))


def test_interval_run_equals_whole_run(spark, inputs, whole):
    got = run_interval(spark, inputs, "int_team_rest_days", "1997-03-01", "1997-06-01")
    want = whole["int_team_rest_days"].filter("game_date >= '1997-03-01' and game_date < '1997-06-01'")
    assert as_rows(got) == as_rows(want)


@pytest.mark.parametrize("name", ["int_team_streaks", "int_team_h2h_stats", "int_game_injury_features", "int_team_opp_tier_ha"])
def test_one_row_per_game(whole, name):
    df = whole[name]
    assert df.count() == df.select("game_id").distinct().count() == whole.games.count()


def test_hand_history(spark):
    """Two teams, seven games: first game, double game on a day, tie, unplayed, overtime."""
    d = lambda i: dt.date(2024, 1, i)
    g = [(1, d(1), 1, 2, 100, 90, "Final"), (2, d(3), 2, 1, 95, 99, "Final/OT"), (3, d(3), 1, 2, 80, 80, "Final"), (4, d(4), 1, 2, 70, 90, "Final"),
         (5, d(10), 2, 1, 88, 91, "Final"), (6, d(11), 1, 2, 120, 100, "Final"), (7, d(12), 1, 2, None, None, "Scheduled")]
    df = spark.createDataFrame(g, "game_id long, game_date date, home_team_id int, away_team_id int, home_score int, away_score int, game_status string")
    games = df.select(
        "*", F.lit("2024").alias("season"), F.when(F.col("home_score") > F.col("away_score"), F.col("home_team_id")).when(F.col("away_score") > F.col("home_score"), F.col("away_team_id")).alias("winner_team_id"),
        F.col("game_status").like("%OT%").alias("is_overtime"), F.col("home_score").isNotNull().alias("is_completed"))
    m = Models(spark, {"stg_games": games})
    s = {r.game_id: r for r in m["int_team_streaks"].collect()}
    # Team 1 results in order: W W (tie counts as loss) L, L, W, W.
    assert (s[1].home_win_streak, s[2].away_win_streak, s[3].home_win_streak) == (0, 1, 2)
    assert (s[4].home_loss_streak, s[5].away_loss_streak, s[6].home_win_streak) == (1, 2, 1)
    assert (s[7].home_win_streak, s[7].home_loss_streak) == (0, 0)  # not played yet
    r = {x.game_id: x for x in m["int_team_rest_days"].collect()}
    assert (r[1].home_rest_days, r[2].away_rest_days, r[3].home_rest_days, r[5].away_rest_days) == (0, 2, 0, 6)
    assert (r[3].home_back_to_back, r[3].home_back_to_back_with_travel, r[4].home_back_to_back_with_travel) == (True, True, False)
    h = {x.game_id: x for x in m["int_team_h2h_stats"].collect()}
    assert (h[1].h2h_total_games, h[2].h2h_total_games, h[3].h2h_total_games, h[4].h2h_total_games) == (0, 1, 1, 3)
    assert h[1].home_h2h_win_pct == 0.5 and h[2].home_h2h_win_pct == 0.0 and abs(h[4].home_h2h_win_pct - 2 / 3) < 1e-12
    assert h[5].home_h2h_avg_point_diff_3 == ((-4) + 0 + 20) / 3
    o = {x.game_id: x for x in m["int_team_ot_perf"].collect()}
    assert (o[3].home_overtime_game_count, o[4].home_overtime_game_count, o[4].home_overtime_win_pct, o[5].home_overtime_win_pct) == (0, 1, 1.0, 0.0)


def test_group_widths(whole):
    """The feature groups carry the published number of columns."""
    widths = {"int_momentum_group_basic": 83, "int_momentum_group_h2h": 32}
    for name, n in widths.items():
        assert len(whole[name].columns) == n


def test_neutral_values():
    from pyspark.sql import types as T

    d = T.DoubleType()
    assert assembly.neutral("home_clutch_win_pct", d) == 0.5
    assert assembly.neutral("home_underdog_win_pct", d) == 0.3
    assert assembly.neutral("win_pct_vs_strong_diff", d) == 0.0
    assert assembly.neutral("home_playoff_rank", T.IntegerType()) == 30
    assert assembly.neutral("home_back_to_back", T.BooleanType()) is False


def test_chunks_and_bundles(spark):
    a, b = dt.date(2020, 12, 30), dt.date(2021, 1, 3)
    assert list(chunks(a, b, 2)) == [(a, dt.date(2021, 1, 1)), (dt.date(2021, 1, 1), b)]
    assert list(chunks(a, b, None)) == [(a, dt.date(2021, 1, 1)), (dt.date(2021, 1, 1), b)]
    days = [a + dt.timedelta(days=i) for i in range(5)]
    assert bundle(days, 3) == [(a, dt.date(2021, 1, 2)), (dt.date(2021, 1, 2), dt.date(2021, 1, 4))]
    x, y = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, 2.0, 3)], "k int, v double, w int")
    assert schema_diff(x, y) == {"added": ["w"], "removed": [], "retyped": ["v"]}
