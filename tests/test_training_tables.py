"""Learning jobs fit on all rows, and on rows that are written once."""

import pytest
from pyspark.sql import functions as F

from foretally import catalog_ml
from foretally.ml import model
from foretally.plans.registry import Models

FORM = ("win_pct_diff_10", "net_rtg_diff_10", "home_injury_impact_score", "pace_diff_10")


class Graph(Models):
    """A graph whose marts are given."""

    def __getitem__(self, name):
        return self.given if name in ("light_mart", "mart_game_features") else super().__getitem__(name)


@pytest.fixture
def graph(spark, monkeypatch):
    m = Graph(spark, {})
    day = F.date_add(F.lit("1996-01-01").cast("date"), (F.col("id") / 5).cast("int"))
    x = [((F.pmod(F.xxhash64("id", F.lit(i)), F.lit(2000)) / 1000.0) - 1.0).alias(c) for i, c in enumerate(FORM)]
    m.given = spark.range(600).select(F.col("id").alias("game_id"), day.alias("game_date"), *x).withColumn(
        "home_win", (F.col(FORM[0]) + F.col(FORM[1]) / 2 > 0).cast("int")).coalesce(1)
    monkeypatch.setattr(catalog_ml, "_m", lambda spark, d: m)
    yield m
    m.close()


def test_early_stopping_takes_all_rows_of_a_table_over_the_bound(spark, graph, monkeypatch):
    bound, seen = model.bounded, []
    monkeypatch.setattr(model, "bounded", lambda rows: bound(rows, 100))

    def few_trees(train, features, **_):
        seen.append(train.count())
        return model.fit(train, features, trees=3, depth=2, rate=0.3), 3

    monkeypatch.setattr(model, "fit_stopping", few_trees)
    row = catalog_ml.ml_early_stopping(spark, "").first()
    assert seen == [480] and row.n == 120 and row.features == len(FORM)


def test_fits_read_rows_that_are_written_once(spark, graph, monkeypatch):
    plans, fit = [], model.fit

    def watched(train, *args, **options):
        plans.append(train._jdf.queryExecution().optimizedPlan().toString())
        return fit(train, *args, **options)

    monkeypatch.setattr(model, "fit", watched)
    picked = {r.feature: (r.kept_by_rfe, r.kept_by_percentile) for r in catalog_ml.ml_select_features(spark, "").collect()}
    assert set(picked) == set(FORM) and picked[FORM[0]] == (True, True)
    assert len(plans) == 1  # four features are fewer than the six that are kept: one model for both methods
    assert catalog_ml.ml_train_boosted(spark, "").first().n == 120
    assert catalog_ml.ml_stacking(spark, "").first().n == 120
    assert len(plans) == 2 + 9
    assert not any(word in p for p in plans for word in ("Aggregate", "Window", "Join"))


def test_elimination_goes_on_from_given_importances(graph):
    rows = graph["training_split"].drop("part")
    scored = model.selector_importances(rows, list(FORM), trees=3, depth=2)
    got, want = (model.select_features(rows, list(FORM), "rfe", n=2, trees=3, depth=2, **k) for k in ({"scored": scored}, {}))
    assert got == want and len(got) == 2
