"""Learning jobs on MLlib: selection, classifiers, stacking, calibration."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import flag, ratio
from .dataset import hash_share

LABEL, WEIGHT = "home_win", "weight"


#: Least gain in validation loss, relative to the loss, over which boosting goes on.
STOP_BELOW = 0.001
#: Labelled rows a model is fitted on at most, about; chosen by a hash of the game.
MOST_ROWS = 1_000_000


def bounded(rows: DataFrame, most: int = MOST_ROWS, seed: int = 11) -> DataFrame:
    """At most about `most` rows, chosen by a hash of the game."""
    n = rows.count()
    return rows if n <= most else rows.filter(hash_share("game_id", seed) < most / n)


def learner(kind: str = "gbt", trees: int = 300, depth: int = 6, rate: float = 0.03, seed: int = 42, validation: str | None = None):
    """Boosted trees (default), random forest or logistic regression.

    `validation` names a boolean column: boosting stops when the loss on its rows no longer falls.
    """
    base = {"featuresCol": "features", "labelCol": LABEL, "weightCol": WEIGHT}
    if kind == "gbt":
        stop = {"validationIndicatorCol": validation, "validationTol": STOP_BELOW} if validation else {}
        return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=0.8, seed=seed, **stop, **base)
    if kind == "forest":
        return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **base)
    return LogisticRegression(maxIter=100, regParam=0.01, **base)


def fit(train: DataFrame, features: list[str], kind: str = "gbt", **options) -> PipelineModel:
    """Assemble the features and fit; the data stays in the cluster."""
    if WEIGHT not in train.columns:
        train = train.withColumn(WEIGHT, F.lit(1.0))
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), learner(kind, **options)]).fit(train)


def fit_stopping(train: DataFrame, features: list[str], share: float = 0.15, seed: int = 7, **options) -> tuple[PipelineModel, int]:
    """Boosted trees that stop on a random part of the training rows, with the published settings unless `options` say
    otherwise; the model and the number of trees it kept."""
    marked = train.withColumn("_held", hash_share("game_id", seed) < share)
    if WEIGHT not in marked.columns:
        marked = marked.withColumn(WEIGHT, F.lit(1.0))
    stages = [VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), learner("gbt", validation="_held", **options)]
    model = Pipeline(stages=stages).fit(marked)
    return model, model.stages[-1].getNumTrees


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add `p_home`, the predicted class and the plain confidence."""
    out = model.transform(df)
    p = F.get(vector_to_array("probability"), F.lit(1))
    return out.withColumn("p_home", p).withColumn("predicted_value", F.col("prediction").cast("int")).withColumn(
        "base_confidence", F.greatest(p, 1 - p)).drop("features", "rawPrediction", "probability", "prediction")


def importances(model: PipelineModel, features: list[str]) -> list[tuple[str, float, int]]:
    """(feature, score, rank); a linear model is ranked by absolute weight."""
    last = model.stages[-1]
    scores = list(last.featureImportances.toArray()) if hasattr(last, "featureImportances") else [abs(x) for x in last.coefficients.toArray()]
    order = sorted(zip(features, map(float, scores)), key=lambda x: (-x[1], x[0]))
    return [(f, s, i + 1) for i, (f, s) in enumerate(order)]


def selector_importances(train: DataFrame, features: list[str], **options) -> list[tuple[str, float, int]]:
    """Importances by the quick selector model."""
    return importances(fit(train, features, **{"trees": 50, "rate": 0.1, "depth": 5, **options}), features)


def select_features(
    train: DataFrame, features: list[str], method: str = "threshold", n: int = 50, percentile: float = 50.0, threshold: float = 0.001, step: int = 1,
    scored: list[tuple[str, float, int]] | None = None, **options,
) -> list[str]:
    """Recursive elimination, best percentile, or importance threshold, with a quick selector model.

    `scored` are the selector's importances of all features, where the caller has them already.
    """
    left = list(features)
    if method == "rfe":
        while len(left) > n:
            ranked = scored if scored and len(left) == len(features) else selector_importances(train, left, **options)
            drop = min(max(step, 1), len(left) - n)
            gone = {f for f, _, _ in ranked[-drop:]}
            left = [f for f in left if f not in gone]
        return left
    scores = {f: s for f, s, _ in scored or selector_importances(train, left, **options)}
    if method == "percentile":
        values = sorted(scores.values())
        pos = (len(values) - 1) * (100.0 - percentile) / 100.0
        lo = int(pos)
        cut = values[lo] + (values[min(lo + 1, len(values) - 1)] - values[lo]) * (pos - lo)
        return [f for f in left if scores[f] >= cut]
    return [f for f in left if scores[f] >= threshold]


def fit_stack(train: DataFrame, features: list[str], kinds: tuple[str, str] = ("gbt", "forest"), folds: int = 5, seed: int = 7, **options):
    """Two learners plus a logistic model on their out-of-fold probabilities."""
    if WEIGHT not in train.columns:
        train = train.withColumn(WEIGHT, F.lit(1.0))
    marked = train.withColumn("_fold", F.floor(hash_share("game_id", seed) * folds).cast("int"))
    parts = []
    for k in range(folds):
        held, rest = marked.filter(F.col("_fold") == k), marked.filter(F.col("_fold") != k)
        for i, kind in enumerate(kinds):
            held = predict(fit(rest, features, kind, **options), held).withColumnRenamed("p_home", f"_p{i}").drop("predicted_value", "base_confidence")
        parts.append(held.select("game_id", LABEL, WEIGHT, *[f"_p{i}" for i in range(len(kinds))]))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    meta = fit(oof, [f"_p{i}" for i in range(len(kinds))], "logistic")
    return [fit(train, features, kind, **options) for kind in kinds], meta


def predict_stack(stack, df: DataFrame) -> DataFrame:
    models, meta = stack
    out = df
    for i, mdl in enumerate(models):
        out = predict(mdl, out).withColumnRenamed("p_home", f"_p{i}").drop("predicted_value", "base_confidence")
    return predict(meta, out).drop(*[f"_p{i}" for i in range(len(models))])


def log_odds(p):
    """log(p / (1 - p)), kept finite at 0 and 1."""
    q = F.greatest(F.lit(1e-10), F.least(p, F.lit(1 - 1e-10)))
    return F.log(q / (1 - q))


def fit_platt(validation: DataFrame) -> tuple[float, float]:
    """Slope and intercept of a logistic fit of the label on the log-odds of p_home."""
    rows = validation.select(F.col(LABEL).cast("double").alias(LABEL), log_odds(F.col("p_home")).alias("lo"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["lo"], outputCol="features"), LogisticRegression(featuresCol="features", labelCol=LABEL)]).fit(rows)
    last = model.stages[-1]
    return float(last.coefficients[0]), float(last.intercept)


def apply_platt(df: DataFrame, slope: float, intercept: float) -> DataFrame:
    """Calibrated P(home) and the confidence of the more likely side.

    The curve is fitted on P(home), so it is applied to P(home) too; the
    confidence follows from the calibrated value.
    """
    p = 1 / (1 + F.exp(-(F.lit(slope) * log_odds(F.col("p_home")) + F.lit(intercept))))
    return df.withColumn("p_home", p).withColumn("base_confidence", F.greatest(F.col("p_home"), 1 - F.col("p_home")))


def fit_isotonic(validation: DataFrame):
    return IsotonicRegression(featuresCol="p_home", labelCol=LABEL).fit(validation.select(F.col(LABEL).cast("double").alias(LABEL), "p_home"))


def apply_isotonic(model, df: DataFrame) -> DataFrame:
    p = F.greatest(F.lit(0.0), F.least(F.col("prediction"), F.lit(1.0)))
    out = model.transform(df).withColumn("p_home", p).drop("prediction")
    return out.withColumn("base_confidence", F.greatest(F.col("p_home"), 1 - F.col("p_home")))


def calibration_bins(df: DataFrame, p: str = "p_home", y: str = LABEL, bins: int = 10) -> DataFrame:
    """Uniform bins of the probability: mean prediction, observed share, rows."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_predicted"), F.avg(F.col(y).cast("double")).alias("observed"))


def calibration_error(df: DataFrame, p: str = "p_home", y: str = LABEL, bins: int = 10) -> DataFrame:
    """Brier score and the unweighted mean gap over non-empty bins."""
    gap = calibration_bins(df, p, y, bins).agg(F.avg(F.abs(F.col("observed") - F.col("mean_predicted"))).alias("calibration_error"))
    brier = df.agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"))
    from ..functions.numeric import with_scalars

    return with_scalars(brier, gap)


def class_report(df: DataFrame, pred: str = "predicted_value", y: str = LABEL) -> DataFrame:
    """Confusion counts per label with precision, recall and F1 of that label."""
    cells = df.groupBy(F.col(y).cast("int").alias("y"), F.col(pred).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    labels = cells.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("label"), "y", "p", "n")
    tp, guess, real = (F.sum(F.when(c, F.col("n")).otherwise(0)) for c in (
        (F.col("y") == F.col("label")) & (F.col("p") == F.col("label")), F.col("p") == F.col("label"), F.col("y") == F.col("label")))
    g = labels.groupBy("label").agg(tp.alias("hits"), guess.alias("predicted"), real.alias("actual"))
    prec, rec = F.coalesce(ratio("hits", "predicted"), F.lit(0.0)), F.coalesce(ratio("hits", "actual"), F.lit(0.0))
    return g.select("*", prec.alias("precision"), rec.alias("recall"), F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"))


def registry_rows(spark, name: str, version: str, model_id: str, metrics: dict[str, float], ranked: list[tuple[str, float, int]], created_at: str):
    """(registry row, importance rows) of a trained model, ready for the keyed writes."""
    reg = spark.createDataFrame([(name, version, model_id, metrics, created_at, True)],
                                "model_name string, model_version string, model_id string, metrics map<string,double>, created_at string, is_active boolean")
    imp = spark.createDataFrame([(model_id, f, s, r) for f, s, r in ranked], "model_id string, feature_name string, importance_score double, importance_rank int")
    return reg, imp


def accuracy(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(flag(F.col("predicted_value") == F.col(LABEL))).alias("accuracy"))
