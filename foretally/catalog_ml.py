"""Queries over the learning, scoring and analysis jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.numeric import flag
from .ml import analysis, contributions, dataset, model, scoring, store
from .plans.registry import Models
from .plans.registry import model as register


@register("light_mart", table=True)
def light_mart(m: Models) -> DataFrame:
    """A narrow mart for the jobs here: form, rest and injury features per finished game."""
    c = m["team_game_context"].filter("is_home").selectExpr(
        "game_id", "game_date", "case when winner_team_id is not null then is_win end as home_win", "pts as home_score", "opp_pts as away_score", "wp10", "o_wp10",
        *[f"{k} - o_{k} as {n}" for k, n in (("wp10", "win_pct_diff_10"), ("nr10", "net_rtg_diff_10"), ("off10", "off_rtg_diff_10"), ("def10", "def_rtg_diff_10"), ("pace10", "pace_diff_10"))])
    rest = m["int_team_rest_days"].select("game_id", "home_rest_days", "away_rest_days", "rest_advantage", "home_back_to_back")
    inj = m["int_game_injury_features"].select("game_id", "home_injury_impact_score", "away_injury_impact_score", "injury_impact_diff")
    out = c.join(rest, "game_id").join(inj, "game_id")
    return out.selectExpr(
        "*", *[f"case when {w} > 0 then {s}_injury_impact_score / ({w} * 100) else 0D end as {s}_injury_impact_ratio" for s, w in (("home", "wp10"), ("away", "o_wp10"))],
        "least(3000D, greatest(-3000D, -injury_impact_diff)) as injury_advantage_home").drop("wp10", "o_wp10")


def _m(spark, d) -> Models:
    from .catalog import graph

    return graph(spark, d)


def _dense(m: Models):
    rows = dataset.training_rows(m["light_mart"], "1995-06-01", "2001-06-01")
    feats = dataset.feature_columns(rows)
    return dataset.dense_rows(rows, feats), feats


def _training(spark, d):
    return _dense(_m(spark, d))


@register("training_split", table=True)
def training_split(m: Models) -> DataFrame:
    """Training rows, the newest fifth marked as test; written once, as every fit reads its rows several times."""
    return dataset.split_by_time(_dense(m)[0], 0.2)


@register("training_weighted", table=True)
def training_weighted(m: Models) -> DataFrame:
    """The train part with sample weights, written once for all fits on it."""
    return dataset.sample_weights(m["training_split"].filter("part = 'train'"), _dense(m)[1])


def _predictions(spark, d):
    """Predictions of a fixed logistic score over form differences, two model versions."""
    f = _m(spark, d)["light_mart"]
    z = F.coalesce(F.col("net_rtg_diff_10"), F.lit(0.0)) * 0.08 + F.coalesce(F.col("win_pct_diff_10"), F.lit(0.0)) * 1.5
    p = F.round((1 / (1 + F.exp(-z))).cast("decimal(18,9)"), 6).cast("double")
    return f.select((F.col("game_id") * 10).alias("prediction_id"), "game_id", F.concat(F.lit("m"), F.col("game_id") % 2).alias("model_id"), p.alias("p_home"),
                    flag(p >= 0.5).alias("predicted_value"), F.greatest(p, 1 - p).alias("base_confidence"), "home_win", "home_injury_impact_ratio", "away_injury_impact_ratio", "injury_advantage_home")


def _scored(spark, d):
    return scoring.scored(_predictions(spark, d), 0.55)


def ml_training_rows(spark, d):
    """Rows with at most 15 % missing features, all features as numbers."""
    return _training(spark, d)[0]


def ml_interactions(spark, d):
    rows = _training(spark, d)[0].selectExpr("game_id", "win_pct_diff_10", "net_rtg_diff_10", "off_rtg_diff_10", "def_rtg_diff_10", "rest_advantage", "injury_impact_diff",
                                             "home_injury_impact_score as home_rolling_5_apg", "away_rest_days as home_rolling_5_possessions")
    return dataset.with_interactions(rows)


def ml_split_by_day(spark, d):
    return dataset.split_by_day(_training(spark, d)[0].select("game_id", "game_date"), "2000-01-01")


def ml_split_by_time(spark, d):
    return dataset.split_by_time(_training(spark, d)[0].select("game_id", "game_date"), 0.2)


def ml_split_random(spark, d):
    s = dataset.split_random(_training(spark, d)[0].select("game_id", "home_win"), 0.2, 42)
    return dataset.split_random(s, 0.15, 7, ("fit", "validation"), "part_of_train")


def ml_sample_weights(spark, d):
    rows, feats = _training(spark, d)
    return dataset.sample_weights(rows, feats).select("game_id", "weight")


def _small_fit(spark, d, kind="gbt", **options):
    m = _m(spark, d)
    feats = _dense(m)[1]
    opts = {"trees": 10, "depth": 3, "rate": 0.1, **options} if kind != "logistic" else {}
    return model.fit(m["training_weighted"], feats, kind, **opts), m["training_split"], feats


def ml_train_boosted(spark, d):
    """Boosted trees on the older games: accuracy on the newer ones (rows-only check)."""
    mdl, s, _ = _small_fit(spark, d)
    return model.accuracy(model.predict(mdl, s.filter("part = 'test'")))


def ml_train_forest(spark, d):
    mdl, s, _ = _small_fit(spark, d, "forest")
    return model.accuracy(model.predict(mdl, s.filter("part = 'test'")))


def ml_class_report(spark, d):
    return model.class_report(_predictions(spark, d).filter("home_win is not null"))


def ml_importances(spark, d):
    """Importances of a fitted model, registered with its accuracy on the newer games."""
    mdl, s, feats = _small_fit(spark, d)
    reached = model.accuracy(model.predict(mdl, s.filter("part = 'test'"))).first()["accuracy"]
    reg, imp = model.registry_rows(spark, "game_winner", "1.0", "m0", {"accuracy": float(reached or 0.0)}, model.importances(mdl, feats), "2024-01-01")
    return imp.join(reg.select("model_id", "model_version", F.col("metrics")["accuracy"].alias("accuracy")), "model_id")


def ml_early_stopping(spark, d):
    """Published settings (300 trees, depth 6, rate 0.03) on the whole mart, stopped on 15 % of the training rows: trees
    kept, and accuracy on the newer games."""
    rows = dataset.training_rows(_m(spark, d)["mart_game_features"], "1995-06-01", "2001-06-01")
    feats = dataset.feature_columns(rows)
    s = _m(spark, d).written(dataset.split_by_time(dataset.dense_rows(rows, feats), 0.2), "training")
    train = s.filter("part = 'train'")
    mdl, trees = model.fit_stopping(train, feats)
    return model.accuracy(model.predict(mdl, s.filter("part = 'test'"))).withColumn("trees", F.lit(trees)).withColumn("features", F.lit(len(feats)))


_STORES: dict[tuple[str, str], str] = {}


def _store(spark, d):
    """Folder of stored models of this session and data: two versions, the second active."""
    from .plans.registry import shared_dir
    import uuid

    key = (spark.sparkContext.applicationId, d)
    if key not in _STORES:
        root = f"{shared_dir(spark)}/foretally-models-{uuid.uuid4().hex[:8]}"
        for version, options in (("1.0", {"trees": 5}), ("1.1", {})):
            mdl, s, feats = _small_fit(spark, d, **options)
            reached = model.accuracy(model.predict(mdl, s.filter("part = 'test'"))).first()
            model_id = store.store(spark, root, mdl, "game_winner", version, feats, {"accuracy": float(reached["accuracy"] or 0.0), "rows": float(reached["n"])}, f"2024-0{int(version[-1]) + 1}-01")
        store.activate(spark, root, "game_winner", model_id)
        _STORES[key] = root
    return _STORES[key]


def ml_stored_models(spark, d):
    """The registry: versions with their accuracy, which is active, and how many importances are stored."""
    root = _store(spark, d)
    n = store.stored_importances(spark, root).groupBy("model_id").agg(F.count(F.lit(1)).alias("importances"))
    return store.registry(spark, root).join(n, "model_id").select("model_name", "model_version", "model_id", F.col("metrics")["accuracy"].alias("accuracy"), "is_active", "importances")


def ml_scored_by_active(spark, d):
    """All games scored by the active stored version, confidence lowered for injuries."""
    rows, _ = _training(spark, d)
    p = store.score_with_active(rows, _store(spark, d), "game_winner")
    return scoring.scored(p, 0.5).select("game_id", "model_id", "predicted_value", "p_home", "base_confidence", "confidence")


def ml_tree_contributions(spark, d):
    """Contributions of every feature to the margin of the active stored version, per game."""
    rows, _ = _training(spark, d)
    _, feats, mdl = store.active(spark, _store(spark, d), "game_winner")
    trees = contributions.trees_of(mdl, spark, f"{_store(spark, d)}/trees")
    return contributions.by_feature(contributions.tree_contributions(rows, feats, trees), feats)


def ml_tree_mean_contributions(spark, d):
    """Mean absolute contribution of each feature."""
    return analysis.mean_contributions(ml_tree_contributions(spark, d))


def ml_select_features(spark, d):
    rows, feats = _training(spark, d)
    # both methods start from the same model of all features
    scored = model.selector_importances(rows, feats, trees=5, depth=3)
    kept = model.select_features(rows, feats, "rfe", n=6, step=2, scored=scored, trees=5, depth=3)
    best = model.select_features(rows, feats, "percentile", percentile=50, scored=scored, trees=5, depth=3)
    return spark.createDataFrame([(f, f in kept, f in best) for f in feats], "feature string, kept_by_rfe boolean, kept_by_percentile boolean")


def ml_stacking(spark, d):
    m = _m(spark, d)
    s, feats = m["training_split"], _dense(m)[1]
    stack = model.fit_stack(s.filter("part = 'train'").drop("part"), feats, ("forest", "logistic"), folds=3, trees=5, depth=3)
    return model.accuracy(model.predict_stack(stack, s.filter("part = 'test'")))


def ml_platt(spark, d):
    p = _predictions(spark, d).filter("home_win is not null")
    a, b = model.fit_platt(p)
    return model.calibration_error(model.apply_platt(p, a, b))


def ml_isotonic(spark, d):
    p = _predictions(spark, d).filter("home_win is not null")
    return model.calibration_error(model.apply_isotonic(model.fit_isotonic(p), p))


def ml_calibration_bins(spark, d):
    return model.calibration_bins(_predictions(spark, d).filter("home_win is not null"))


def ml_calibration_error(spark, d):
    return model.calibration_error(_predictions(spark, d).filter("home_win is not null"))


def ml_games_to_score(spark, d):
    g = _m(spark, d).games.select("game_id", "game_date", "home_score")
    parts = [scoring.games_to_score(g, "future", "1999-01-01").withColumn("mode", F.lit("future")), scoring.games_to_score(g, "day", "1999-01-05").withColumn("mode", F.lit("day")),
             scoring.games_to_score(g, "range", start="1999-01-01", end="1999-02-01").withColumn("mode", F.lit("range"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("home_score")


def ml_scored(spark, d):
    return _scored(spark, d).select("prediction_id", "game_id", "predicted_value", "base_confidence", "confidence")


def ml_evaluation(spark, d):
    return scoring.evaluate(_scored(spark, d), _m(spark, d)["light_mart"])


def ml_store_outcomes(spark, d):
    p = _scored(spark, d)
    rows = scoring.outcome_rows(p.select("prediction_id", "game_id", "predicted_value"), _m(spark, d)["light_mart"])
    stored = p.filter("game_id % 3 = 0").select("prediction_id", F.lit(None).cast("int").alias("actual_value"), F.lit(None).cast("boolean").alias("is_correct"))
    return scoring.store_outcomes(stored, rows)


CORRELATED = ["win_pct_diff_10", "net_rtg_diff_10", "off_rtg_diff_10", "def_rtg_diff_10", "pace_diff_10", "home_rest_days", "rest_advantage", "home_injury_impact_score", "injury_impact_diff"]


def ml_correlated_pairs(spark, d):
    return analysis.correlated_pairs(_training(spark, d)[0], CORRELATED, 0.5)


def ml_target_correlation(spark, d):
    return analysis.target_correlation(_training(spark, d)[0], CORRELATED)


def ml_removal_advice(spark, d):
    rows = _training(spark, d)[0]
    # Importances stand for a trained model: the correlation with the label, scaled.
    imp = analysis.target_correlation(rows, CORRELATED).select(F.lit("m0").alias("model_id"), F.col("feature").alias("feature_name"), (F.col("correlation") / 10).alias("importance_score"))
    return analysis.removal_advice(analysis.correlated_pairs(rows, CORRELATED, 0.5), imp, 0.002)


LINEAR = {"win_pct_diff_10": 1.5, "net_rtg_diff_10": 0.08, "rest_advantage": 0.02, "injury_impact_diff": -0.001}


def ml_contributions(spark, d):
    return analysis.linear_contributions(_training(spark, d)[0], LINEAR)


def ml_mean_contributions(spark, d):
    groups = spark.createDataFrame([("win_pct_diff_10", "form"), ("net_rtg_diff_10", "form"), ("rest_advantage", "rest"), ("injury_impact_diff", "injury")], "feature string, grp string")
    return analysis.mean_contributions(ml_contributions(spark, d), groups)


def ml_permutation(spark, d):
    mdl, s, feats = _small_fit(spark, d, "logistic")
    test = s.filter("part = 'test'")
    return analysis.permutation_importance(lambda x: model.predict(mdl, x), test, feats)


def an_prediction_errors(spark, d):
    return analysis.prediction_errors(_scored(spark, d), _m(spark, d).games)


def an_wrong_by_injury(spark, d):
    return analysis.wrong_by_injury(_scored(spark, d).select("game_id", "confidence", "predicted_value"), _m(spark, d)["light_mart"])


def an_upset_types(spark, d):
    return analysis.upset_types(_m(spark, d).tg)


def _registry(spark):
    return spark.createDataFrame([("winner", "1.0", "m0", "2024-01-01", True), ("winner", "1.1", "m1", "2024-02-01", True), ("winner", "1.2", "m2", "2024-03-01", False)],
                                 "model_name string, model_version string, model_id string, created_at string, is_active boolean")


def an_latest_model(spark, d):
    """Predictions of the newest active model."""
    return _scored(spark, d).select("prediction_id", "model_id").join(analysis.latest_model(_registry(spark)), "model_id")


def an_compare_versions(spark, d):
    p = _scored(spark, d).select("prediction_id", "game_id", "model_id", "predicted_value", "confidence")
    other = p.withColumn("model_id", F.when(F.col("model_id") == "m0", "m1").otherwise("m0")).withColumn("predicted_value", F.when(F.col("game_id") % 4 == 0, 1 - F.col("predicted_value")).otherwise(F.col("predicted_value"))).withColumn(
        "confidence", F.col("confidence") * 0.9)
    return analysis.compare_versions(p.unionByName(other), _registry(spark))


def an_latest_odds(spark, d):
    from .catalog_sources import src_betting_odds

    o = src_betting_odds(spark, d).withColumn("captured_at", F.when(F.col("book_name") == "BookA", F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")))
    odds = F.when(F.col("game_id").cast("long") % 3 == 0, F.col("away_odds") * 100).when(F.col("game_id").cast("long") % 3 == 1, -F.col("away_odds") * 100).otherwise(F.col("away_odds"))
    return analysis.latest_odds(o.withColumn("away_odds", odds))


def an_matchup_report(spark, d):
    return analysis.matchup_report(_m(spark, d).tg, (3, 7), "1999-06-01")


def an_key_players(spark, d):
    m = _m(spark, d)
    return analysis.key_players(m.games, m["stg_player_boxscores"], (3, 7), "1999-03-02", 12.0)


def an_against_history(spark, d):
    rows = _training(spark, d)[0]
    return analysis.against_history(rows, CORRELATED, rows.filter("game_date = date '1999-03-01'"))


def an_injury_list(spark, d):
    m = _m(spark, d)
    return analysis.injury_list(m.games, m["stg_injuries"], m["players"], m["int_star_players"])


def an_injury_bands(spark, d):
    return analysis.injury_bands(_m(spark, d)["light_mart"].withColumn("injury_impact_diff", F.col("injury_impact_diff") / 100), "1996-01-01")


def an_injury_distribution(spark, d):
    return analysis.injury_distribution(_m(spark, d)["light_mart"])


QUERIES = {f.__name__: f for f in (
    ml_training_rows, ml_interactions, ml_split_by_day, ml_split_by_time, ml_split_random, ml_sample_weights, ml_train_boosted, ml_train_forest, ml_class_report, ml_importances,
    ml_early_stopping, ml_stored_models, ml_scored_by_active, ml_tree_contributions, ml_tree_mean_contributions,
    ml_select_features, ml_stacking, ml_platt, ml_isotonic, ml_calibration_bins, ml_calibration_error, ml_games_to_score, ml_scored, ml_evaluation, ml_store_outcomes,
    ml_correlated_pairs, ml_target_correlation, ml_removal_advice, ml_contributions, ml_mean_contributions, ml_permutation, an_prediction_errors, an_wrong_by_injury,
    an_upset_types, an_latest_model, an_compare_versions, an_latest_odds, an_matchup_report, an_key_players, an_against_history, an_injury_list, an_injury_bands, an_injury_distribution)}
