"""How often rows move on their way through the history operators, and what is not computed for those who do not ask."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from foretally.operators import history
from foretally.operators.scratch import kept, written_by
from foretally.plans import core, players  # noqa: F401  (register the models)
from foretally.plans.registry import Models, one_key_enough, write_table
from foretally.plans.views import staging_from_star

DAY = dt.date(2024, 1, 1)


@pytest.fixture
def write(spark, tmp_path):
    return lambda df, name: write_table(df, spark, name, f"file:{tmp_path}")


def facts(days, most):
    pick = random.Random(5)
    at = 0
    for ent in (1, 2, None):
        for d in [*range(days), None]:
            for _ in range(pick.randint(0, most)):
                at += 1
                yield ent, d if d is None else DAY + dt.timedelta(days=d), at, None if at % 7 == 0 else at % 5


def moves(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("block", (1, 3, 10, None))
def test_frames_over_whole_days_in_blocks_equal_brute_force(spark, write, block):
    rows = list(facts(9, 6)) + [(3, DAY, 10_000 + i, i) for i in range(40)] + [(3, DAY + dt.timedelta(days=i), 20_000 + i, i) for i in range(1, 12)]
    with written_by(write):
        got = history.prior_rows(spark.createDataFrame(rows, "ent int, day date, id long, x int"), ["ent"], "day", ["id"], depth=4, block_rows=block, keep_rank=True,
                                 exprs=lambda w: {"s": F.sum("x").over(w(-4, -1)), "before": F.lag("id").over(w(None, None))}).collect()
    want = {}
    for ent in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == ent), key=lambda r: (r[1] is None, r[1] or DAY, r[2]))
        for i, r in enumerate(own):
            xs = [y[3] for y in own[max(0, i - 4) : i] if y[3] is not None]
            want[r[2]] = (i + 1, sum(xs) if xs else None, own[i - 1][2] if i else None)
    assert len(got) == len(rows) and {r.id: (r._rn, r.s, r.before) for r in got} == want


def test_rows_of_a_frame_move_once_when_the_day_table_is_written(spark, write):
    df = spark.createDataFrame(list(facts(9, 6)), "ent int, day date, id long, x int")
    with written_by(write):
        got = history.prior_rows(df, ["ent"], "day", ["id"], depth=4, exprs=lambda w: {"s": F.sum("x").over(w(-4, -1))})
        table = history.prior_days(df, ["ent"], "day", [history.Measure("n", "count", F.lit(1))])
        joined = history.attach(df, table, ["ent", "day"])
    assert moves(got) == 1 and moves(joined) == 0
    assert kept(df, "any") is df


def test_opponent_models_do_not_make_the_forty_rolling_columns(spark):
    m = Models(spark, staging_from_star(spark, "/root/testdata/sf0.001"))
    context = m["team_game_context"]
    assert context.filter("o_wp10 is not null").count() > 0
    assert not {"int_team_rolling_stats", "int_team_roll_lkp"} & set(m._built)
    m.close()


def test_player_rows_are_made_once_for_all_models_that_read_them(spark):
    m = Models(spark, staging_from_star(spark, "/root/testdata/sf0.001"))
    read = [m[n]._jdf.queryExecution().optimizedPlan().toString() for n in ("int_star_players", "injury_star_reports", "int_star_player_avail", "int_game_injury_features")]
    assert not any("l_returnflag" in p or "l_quantity" in p for p in read)
    m.close()


def test_rows_that_lie_together_by_game_join_on_game_and_team_without_moving(spark):
    a, b = (spark.range(40).selectExpr("id div 2 as game_id", "id % 2 as team_id", f"id as {c}").repartition("game_id") for c in "ab")
    setting = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")

    def by_both():
        plan = a.hint("merge").join(b, ["game_id", "team_id"])._jdf.queryExecution().executedPlan().toString()
        return len(re.findall(r"hashpartitioning\(game_id#\d+L?, team_id", plan))

    apart = by_both()
    with one_key_enough(spark):
        together = by_both()
    assert (apart, together) == (2, 0) and spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == setting
