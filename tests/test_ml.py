"""Probabilities, calibration and scoring by hand."""

import math

from pyspark.sql import functions as F

from foretally.ml import analysis, model, scoring


def test_brier_and_bins(spark):
    rows = [(0.05, 0), (0.15, 0), (0.15, 1), (0.55, 1), (0.95, 1), (1.0, 1)]
    df = spark.createDataFrame(rows, "p_home double, home_win int")
    got = model.calibration_error(df).collect()[0]
    assert math.isclose(got.brier, sum((p - y) ** 2 for p, y in rows) / 6)
    gaps = [0.05, abs(0.5 - 0.15), 0.45, abs(1 - 0.975)]
    assert math.isclose(got.calibration_error, sum(gaps) / 4, abs_tol=1e-9)


def test_confidence_penalties(spark):
    rows = [(0.8, 5.0, 0.0, 0.0), (0.8, 15.0, 0.0, 0.0), (0.8, 100.0, 0.0, 0.0), (0.8, 0.0, None, -2000.0), (0.12, 100.0, 0.0, 9999.0)]
    df = spark.createDataFrame(rows, "b double, h double, a double, v double")
    got = [r.c for r in df.select(scoring.injury_adjusted(F.col("b"), F.col("h"), F.col("a"), F.col("v")).alias("c")).collect()]
    want = [0.8, 0.8 * 0.9, 0.8 * 0.6, 0.8 * 0.9, 0.1]
    assert all(math.isclose(x, y, abs_tol=1e-12) for x, y in zip(got, want))


def test_platt_moves_towards_the_outcome(spark):
    df = spark.createDataFrame([(i, 0.9 if i % 2 else 0.1, int(i % 2 == 0 or i % 5 == 0)) for i in range(60)], "game_id int, p_home double, home_win int")
    a, b = model.fit_platt(df)
    assert a < 0  # the score is inverted, so the slope is negative
    out = model.apply_platt(df, a, b)
    assert model.calibration_error(out).collect()[0].brier < model.calibration_error(df).collect()[0].brier


def test_evaluation_needs_enough_rows(spark):
    p = spark.createDataFrame([(1, 1, 0.6)], "game_id int, predicted_value int, confidence double")
    m = spark.createDataFrame([(1, 1)], "game_id int, home_win int")
    assert scoring.evaluate(p, m).count() == 0
    r = scoring.evaluate(p, m, min_rows=1).collect()[0]
    assert (r.accuracy, r.precision, r.upset_accuracy) == (1.0, 1.0, 0.0)


def test_payouts(spark):
    df = spark.createDataFrame([(1.952,), (150.0,), (-200.0,)], "o double")
    profit, kind = analysis.payout(F.col("o"))
    got = [(round(r.p, 2), r.k) for r in df.select(profit.alias("p"), kind.alias("k")).collect()]
    assert got == [(9.52, "decimal"), (15.0, "american_underdog"), (5.0, "american_favorite")]


def test_every_feature_is_judged(spark):
    from foretally import catalog_ml
    from tests.conftest import SF

    _, feats = catalog_ml._training(spark, SF)
    assert len(feats) > 10
    for query in (catalog_ml.ml_select_features, catalog_ml.ml_permutation):
        assert sorted(r.feature for r in query(spark, SF).collect()) == sorted(feats)
