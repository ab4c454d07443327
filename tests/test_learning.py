"""Stored models, early stopping, contributions of trees, importances by permutation."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foretally.ml import analysis, contributions, model, store

FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def games(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1_500):
        x = [rng.gauss(0, 1) for _ in FEATURES]
        p = 1 / (1 + math.exp(-(1.5 * x[0] - x[1] + x[2] * x[3])))
        rows.append((i, int(rng.random() < p), *x))
    return spark.createDataFrame(rows, "game_id long, home_win int, " + ", ".join(f"{c} double" for c in FEATURES))


def expected(tree, x, known, node=0):
    """Mean value of a tree where only the features in `known` are."""
    if tree.left[node] < 0:
        return tree.value[node]
    down = tree.left[node], tree.right[node]
    if tree.feature[node] in known:
        return expected(tree, x, known, down[0] if x[tree.feature[node]] <= tree.threshold[node] else down[1])
    return sum(tree.cover[n] / tree.cover[node] * expected(tree, x, known, n) for n in down)


def by_subsets(trees, x):
    m, out = len(x), np.zeros(len(x))
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for k in range(m):
            weight = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
            for s in itertools.combinations(others, k):
                out[i] += weight * sum(expected(t, x, {*s, i}) - expected(t, x, set(s)) for t in trees)
    return out


@pytest.mark.parametrize(("kind", "depth"), [("gbt", 4), ("forest", 3)])
def test_contributions_equal_subset_enumeration(spark, games, tmp_path, kind, depth):
    fitted = model.fit(games, FEATURES, kind, trees=4, depth=depth, **({"rate": 0.3} if kind == "gbt" else {}))
    trees = contributions.trees_of(fitted, spark, str(tmp_path / "trees"))
    rows = games.filter("game_id < 40")
    got = {r.game_id: r for r in contributions.tree_contributions(rows, FEATURES, trees).collect()}
    scored = {r.game_id: r for r in fitted.transform(rows).collect()}
    for r in rows.collect():
        x = [r[c] for c in FEATURES]
        assert got[r.game_id].contributions == pytest.approx(by_subsets(trees, x), abs=1e-9)
        p = float(scored[r.game_id].probability[1])
        margin = p if kind == "forest" else math.log(p / (1 - p)) / 2
        assert got[r.game_id].score == pytest.approx(margin, abs=1e-6)
        assert sum(got[r.game_id].contributions) == pytest.approx(got[r.game_id].score - got[r.game_id].mean_score)
    each = contributions.by_feature(contributions.tree_contributions(rows, FEATURES, trees), FEATURES)
    mean = {r.feature: r.mean_abs_contribution for r in analysis.mean_contributions(each).collect()}
    assert set(mean) == set(FEATURES) and mean["a"] > mean["e"]


def test_permutation_importance_in_one_pass(spark, games):
    fitted = model.fit(games, FEATURES, "logistic")
    got = {r.feature: r.importance for r in analysis.permutation_importance(lambda df: model.predict(fitted, df), games, FEATURES, together=400).collect()}
    assert set(got) == set(FEATURES) and got["a"] > got["b"] > got["e"] - 0.02 and got["a"] > 0.05
    paired = analysis.with_partner(games, FEATURES, together=400).collect()
    for i in range(len(FEATURES)):  # every value keeps its frequency, and few rows keep theirs
        assert sorted(r["_own"][i] for r in paired) == sorted(r["_other"][i] for r in paired)
        assert sum(r["_own"][i] == r["_other"][i] for r in paired) < 5
    pdf = games.toPandas().set_index("game_id")
    coefficients, intercept = fitted.stages[-1].coefficients.toArray(), fitted.stages[-1].intercept
    other = {r.game_id: r["_other"] for r in paired}

    def hits(k):
        x = pdf[FEATURES].to_numpy().copy()
        if k is not None:
            x[:, k] = [other[i][k] for i in pdf.index]
        return float(((x @ coefficients + intercept > 0) == (pdf["home_win"] == 1)).mean())

    for k, c in enumerate(FEATURES):
        assert got[c] == pytest.approx(hits(None) - hits(k), abs=1e-9)


def test_boosting_stops_when_validation_loss_does(games):
    noise = games.withColumn("home_win", (F.pmod(F.xxhash64("game_id"), F.lit(2))).cast("int"))
    _, few = model.fit_stopping(noise, FEATURES, trees=60, depth=3, rate=0.1)
    fitted, more = model.fit_stopping(games, FEATURES, trees=60, depth=3, rate=0.1)
    assert few < more <= 60
    assert model.accuracy(model.predict(fitted, games)).first().accuracy > 0.7
    assert model.bounded(games, 500).count() < 650 and model.bounded(games, 5_000).count() == games.count()


def test_stored_model_scores_as_the_fitted_one(spark, games, tmp_path):
    root = str(tmp_path / "models")
    fitted = {v: model.fit(games, FEATURES, "gbt", trees=n, depth=3, rate=0.1) for v, n in (("1.0", 3), ("1.1", 6))}
    with pytest.raises(ValueError, match="no active"):
        store.active(spark, root, "winner")
    for v, m in fitted.items():
        store.store(spark, root, m, "winner", v, FEATURES, {"accuracy": 0.5 + len(v) / 100}, f"2024-01-0{v[-1]}")
    with pytest.raises(ValueError, match="not registered"):
        store.activate(spark, root, "winner", "winner-9")
    for v in ("1.0", "1.1", "1.0"):
        store.activate(spark, root, "winner", f"winner-{v}")
        rows = {r.model_version: r for r in store.registry(spark, root).collect()}
        assert {k for k, r in rows.items() if r.is_active} == {v} and rows[v].metrics["accuracy"] == pytest.approx(0.53)
        got = {r.game_id: (r.p_home, r.model_id) for r in store.score_with_active(games, root, "winner").collect()}
        want = {r.game_id: (r.p_home, f"winner-{v}") for r in model.predict(fitted[v], games).collect()}
        assert got == want
    assert store.stored_importances(spark, root).groupBy("model_id").count().count() == 2
