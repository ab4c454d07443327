"""Cases beyond limits that once cut results."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from foretally.functions.numeric import half_up, rounded
from foretally.ml.analysis import injury_list, matchup_report, with_partner
from foretally.ml.dataset import dense_rows
from foretally.plans.assembly import neutral
from foretally.plans.registry import Models


def test_checks_take_only_view_texts_from_the_library():
    for path in Path("oracles").glob("*.py"):
        found = re.findall(r"^\s*(?:from|import) +(foretally[\w.]*)(.*)", path.read_text(), re.M)
        assert all(m == ("foretally.plans.views", " import VIEWS") for m in found), (path, found)


def test_rounding_above_a_billion(spark):
    df = spark.createDataFrame([(1234567890.1234567,), (-9876543210.5678,), (2.5e12,), (1e300,), (1.0000005,)], "x double")
    got = [r.x for r in rounded(df, 2).collect()]
    assert got == [1234567890.12, -9876543210.57, 2.5e12, 1e300, 1.0]
    assert [r.y for r in df.select(half_up("x", 2).alias("y")).collect()] == got


def test_published_halves():
    from pyspark.sql.types import DoubleType

    for side in ("home", "away"):
        assert neutral(f"{side}_win_pct_vs_similar_momentum", DoubleType()) == neutral(f"{side}_win_pct_with_rest_advantage", DoubleType()) == 0.5


def test_permutation_does_not_depend_on_the_order_of_rows(spark):
    small = spark.range(50).select(F.col("id").alias("game_id"), (F.col("id") * 2).alias("v"))
    one, two = (with_partner(df, ["v"], together=7).select("game_id", F.col("_other")[0].alias("v")) for df in (small, small.repartition(7)))
    assert sorted(r.v for r in one.collect()) == [2 * i for i in range(50)]
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_meetings_older_than_the_last_games_count(spark):
    rows = [(i, f"1999-01-{i + 1:02d}", t, o, w, m) for i in range(5) for t, o, w, m in ((3, 7, 1, 4), (7, 3, 0, -4))]
    rows += [(10 + i, f"1999-02-{i + 1:02d}", 3, 9, 0, -1) for i in range(12)]
    tg = spark.createDataFrame(rows, "game_id long, day string, team_id int, opp_id int, is_win int, margin int").withColumn("game_date", F.to_date("day"))
    got = {r.team_id: (r.games, r.head_to_head, r.head_to_head_wins) for r in matchup_report(tg, (3, 7), "1999-03-01").collect()}
    assert got == {3: (10, 5, 5), 7: (5, 5, 0)}


def test_tables_of_a_graph_can_be_deleted(spark):
    m = Models(spark, {})
    df = m.written(spark.range(3).toDF("id"), "x")
    assert df.count() == 3
    path = m._root
    m.close()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def test_injury_list_ranks_once_per_team_and_day(spark):
    games = spark.createDataFrame(
        [(1, "1995-01-08", 3, 4), (2, "1995-01-08", 4, 3), (5, "1995-01-08", 3, 3), (6, "1995-01-08", 3, 4), (6, "1995-01-09", 3, 5), (None, "1995-01-08", 3, 4), (None, "1995-01-05", 4, 3), (7, None, 3, 4)],
        "game_id long, game_date string, home_team_id int, away_team_id int").withColumn("game_date", F.to_date("game_date"))
    reports = spark.createDataFrame(
        [(i, f"1995-01-{d:02d}", n, s) for i, (d, n, s) in enumerate([(1, "a", "Out"), (8, "b", "Out"), (8, "a", "Doubtful"), (9, "a", "Out"), (3, "c", "Out"), (3, "c", "N/A"), (4, "d", "Out")])],
        "injury_id long, capture_date string, player_name string, status string").withColumn("capture_date", F.to_date("capture_date"))
    players = spark.createDataFrame([(31, "a", 3), (32, "b", 3), (41, "c", 4), (33, "d", None)], "player_id int, player_name string, team_id int")
    stars = spark.createDataFrame([(32, "star", 30.0)], "player_id int, player_tier string, impact_score double")
    out = injury_list(games, reports, players, stars)
    lists = {}
    for r in out.collect():
        lists.setdefault((r.game_id, r.team_id), []).append((r["rank"], r.injury_id))
    both = [1, 2, 0]  # of team 3 on 8 January, newest first, then by impact
    want = {(1, 3): both, (2, 3): both, (1, 4): [4], (2, 4): [4], (5, 3): [1, 1, 2, 2, 0, 0], (6, 3): [3, 1, 1, 2, 2, 0], (6, 4): [4], (None, 3): [1, 2, 0, 0], (None, 4): [4, 4]}
    assert {k: [i for _, i in sorted(v)] for k, v in lists.items()} == want
    assert all(sorted(k for k, _ in v) == list(range(1, len(v) + 1)) for v in lists.values())
    # the ranks of games that name a team once come from a window over (team, day)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"row_number\(\) windowspecdefinition\(team_id#\d+, game_date#\d+", plan)


def test_dense_rows_with_very_many_features(spark):
    names = [f"f{i}" for i in range(3_000)]
    df = spark.range(3).select("id", *[F.when(F.col("id") * 300 <= i, 1).alias(c) for i, c in enumerate(names)])
    got = dense_rows(df, names).select("id", "f0", "f2999").collect()
    assert [tuple(r) for r in got] == [(0, 1.0, 1.0), (1, 0.0, 1.0)]
