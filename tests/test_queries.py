"""Registered queries against their DuckDB statements on the smallest tables."""

import datetime as dt
import decimal
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from foretally import catalog
from oracles import all_sql

from .conftest import SF

NAMES = ["int_team_rolling_stats", "int_team_roll_lkp", "int_team_streaks", "int_team_cum_fatigue", "int_team_h2h_stats", "int_team_quality_adj_perf",
         "int_team_playoff_ctx", "int_game_injury_features", "mart_team_standings", "asof_events", "streaks_events", "wr_patch", "dq_lineitem_rules",
         "src_games", "src_transactions", "in_table_diff", "ml_split_by_time", "an_upset_types"]


def norm(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_check(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(str(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    have = [c[0] for c in cur.description]
    assert sorted(have) == cols
    at = [have.index(c) for c in cols]
    assert got == sorted(str(tuple(norm(r[i]) for i in at)) for r in cur.fetchall())


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    rows_only = set(catalog.queries()) - set(all_sql())
    assert rows_only == {"ml_train_boosted", "ml_train_forest", "ml_importances", "ml_select_features", "ml_stacking", "ml_platt", "ml_isotonic", "ml_permutation",
                         "ml_early_stopping", "ml_stored_models", "ml_scored_by_active", "ml_tree_contributions", "ml_tree_mean_contributions"}


def test_entry_without_the_training_data_package():
    code = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("foretally.llm"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
from foretally import catalog
from oracles import all_sql
from foretally import catalog
assert set(entry.queries()) == set(catalog.queries()) and "pipeline" not in entry.queries()
"""
    subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, check=True)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
