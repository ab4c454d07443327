"""Runs by chunks with carried state, and writes of intervals."""

import os
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from foretally import catalog  # noqa: F401  (registers the models)
from foretally.functions.numeric import rounded
from foretally.incremental import backfill
from foretally.operators import history, merge
from foretally.plans.registry import Models
from foretally.plans.views import staging_from_star

from .conftest import SF

START, END = date(1996, 6, 1), date(1998, 3, 1)
#: One model or more for each history operator, and for totals over the whole history.
NAMES = ["int_team_rolling_stats", "int_team_roll_lkp", "int_team_streak_qual", "int_team_h2h_stats", "int_away_upset_tend", "int_team_playoff_ctx",
         "int_team_timing_perf", "int_team_matchup_compat", "int_team_blowout_perf", "int_game_injury_features"]
if os.environ.get("ALL_MODELS"):
    NAMES = [n for n in Models.names() if n.startswith(("int_team_", "int_away", "int_game_injury", "int_star_player_avail")) and n != "int_team_season_stats"]


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    return sorted(str(tuple(r)) for r in rounded(a.select(*cols)).collect()) == sorted(str(tuple(r)) for r in rounded(b.select(*cols)).collect())


def test_backfill_by_chunks_equals_a_run_over_all_days(spark, tmp_path):
    inputs = staging_from_star(spark, SF)
    read = []
    assert backfill(spark, inputs, NAMES, str(tmp_path), START, END, 330, lambda c: read.append((c, *c.rows_read("stg_games")))) == 2
    whole = Models(spark, inputs, start=START.isoformat(), end=END.isoformat())
    assert not [n for n in NAMES if not same(spark.read.parquet(f"{tmp_path}/{n}").drop("day"), whole.output(n))]
    second, rows, state = read[1]
    assert rows == inputs["stg_games"].filter(f"game_date >= '{second.start}' and game_date < '{second.end}'").count() and state > 0
    # the second chunk is run again for one model, from the state at its start
    again = []
    assert backfill(spark, inputs, NAMES[:1], str(tmp_path), second.start, END, 330, lambda c: again.append(c.rows_read("stg_games")[0])) == 1
    assert again == [rows] and same(spark.read.parquet(f"{tmp_path}/{NAMES[0]}").drop("day"), whole.output(NAMES[0]))
    whole.close()


def test_days_that_became_empty_are_gone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, date(2024, 1, 1 + i % 5)) for i in range(20)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, game_date date")
    merge.write_interval(df, path, "game_date", date(2024, 1, 1), date(2024, 1, 6))
    assert spark.read.parquet(path).count() == 20
    merge.write_interval(df.filter("id = 1"), path, "game_date", date(2024, 1, 1), date(2024, 1, 4))
    left = {r.id for r in spark.read.parquet(path).collect()}
    assert left == {1} | {i for i in range(20) if i % 5 >= 3}
    merge.write_interval(df.limit(0), path, "game_date", date(2024, 1, 4), date(2024, 1, 6))
    assert {r.id for r in spark.read.parquet(path).collect()} == {1}


def test_replace_interval_keeps_rows_of_unknown_day(spark):
    kind = "id int, day date"
    target = spark.createDataFrame([(1, date(2024, 1, 1)), (2, None), (3, date(2024, 1, 5))], kind)
    batch = spark.createDataFrame([(4, date(2024, 1, 2)), (5, None), (6, date(2024, 1, 5))], kind)
    assert {r.id for r in merge.replace_interval(target, batch, "day", "2024-01-01", "2024-01-03").collect()} == {2, 3, 4}


@pytest.mark.parametrize("block", [None, 2])
def test_history_keeps_rows_of_null_key_or_day(spark, block):
    duck = duckdb.connect()
    rows = [(i, None if i % 7 == 0 else i % 3, None if i % 5 == 0 else date(2024, 1, 1 + i % 4), None if i % 11 == 0 else i % 6) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, k int, day date, v int")
    ranked = history.ranked(df, ["k"], "day", ["v", "id"], "rn")
    ran = history.running(ranked.drop("_before", "_in_day"), ["k"], "day", ["v", "id"], {"total": F.coalesce("v", F.lit(0))})
    out = history.prior_rows(ran, ["k"], "day", ["v", "id"], 3, lambda w: {"three": F.sum("v").over(w(-3, -1))}, block)
    assert out.count() == len(rows)
    view = out.toPandas()  # noqa: F841  (read by name below)
    duck.register("got_rows", view)
    wrong = duck.execute("""
        select count(*) from (
            select id, rn, total, three, row_number() over w as rn2, coalesce(sum(coalesce(v, 0)) over before, 0) as total2, sum(v) over last3 as three2
            from got_rows
            window w as (partition by k order by day nulls last, v nulls last, id),
                   before as (partition by k order by day nulls last, v nulls last, id rows between unbounded preceding and 1 preceding),
                   last3 as (partition by k order by day nulls last, v nulls last, id rows between 3 preceding and 1 preceding))
        where rn <> rn2 or total <> total2 or three is distinct from three2""").fetchone()[0]
    assert wrong == 0
