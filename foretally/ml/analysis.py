"""Feature analysis and prediction reports."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import flag, nvl, ratio, with_scalars
from ..operators.history import Measure, attach, prior_days
from .model import LABEL


def correlated_pairs(df: DataFrame, features: list[str], threshold: float = 0.95) -> DataFrame:
    """Feature pairs with absolute Pearson correlation at or above the threshold.

    The matrix is computed by the cluster and has (features)^2 cells, whatever the rows.
    """
    spark: SparkSession = df.sparkSession
    vec = VectorAssembler(inputCols=features, outputCol="v").transform(df.na.fill(0.0, features)).select("v")
    m = Correlation.corr(vec, "v").head()[0].toArray()
    rows = [(features[i], features[j], float(abs(m[i][j]))) for i in range(len(features)) for j in range(i + 1, len(features)) if abs(m[i][j]) >= threshold]
    return spark.createDataFrame(rows, "feature_1 string, feature_2 string, correlation double")


def target_correlation(df: DataFrame, features: list[str]) -> DataFrame:
    one = df.na.fill(0.0, features).agg(*[F.abs(F.corr(c, F.col(LABEL).cast("double"))).alias(c) for c in features])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in features])).alias("x")).select("x.*")


def removal_advice(pairs: DataFrame, importance: DataFrame, min_importance: float = 0.001, top: int = 10) -> DataFrame:
    """Which feature of each of the strongest pairs to drop, and the least important features.

    A top-k report: `top` rows of each kind.
    """
    i1 = importance.select(F.col("feature_name").alias("feature_1"), F.col("importance_score").alias("s1"))
    i2 = importance.select(F.col("feature_name").alias("feature_2"), F.col("importance_score").alias("s2"))
    best = pairs.orderBy(F.desc("correlation"), "feature_1", "feature_2").limit(top).join(i1, "feature_1", "left").join(i2, "feature_2", "left")
    first = nvl("s1", 0.0) > nvl("s2", 0.0)
    a = best.select(F.lit("high_correlation").alias("kind"), F.when(first, F.col("feature_2")).otherwise(F.col("feature_1")).alias("feature"),
                    F.when(first, F.col("feature_1")).otherwise(F.col("feature_2")).alias("alternative"), F.col("correlation").alias("value"))
    low = importance.filter(F.col("importance_score") < min_importance).orderBy("importance_score", "feature_name").limit(top)
    return a.unionByName(low.select(F.lit("low_importance").alias("kind"), F.col("feature_name").alias("feature"), F.lit(None).cast("string").alias("alternative"), F.col("importance_score").alias("value")))


def linear_contributions(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Per row and feature w * (x - mean): exact for a linear score."""
    means = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in weights])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), (F.lit(float(w)) * (F.col(c) - F.col(f"_m_{c}"))).alias("contribution")) for c, w in weights.items()])
    return with_scalars(df, means).select("game_id", F.explode(items).alias("x")).select("game_id", "x.*")


def mean_contributions(contributions: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Mean absolute contribution per feature, or per group of features (feature, grp)."""
    c, by = contributions, "feature"
    if groups is not None:
        # The group map has one row per feature.
        c = contributions.join(F.broadcast(groups), "feature").groupBy("game_id", "grp").agg(F.sum("contribution").alias("contribution"))
        by = "grp"
    return c.groupBy(by).agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"), F.avg("contribution").alias("mean_contribution"))


#: Rows of a group inside which values change places, on average.
MIXED_TOGETHER = 50_000


def with_partner(df: DataFrame, features: list[str], seed: int = 1, together: int = MIXED_TOGETHER) -> DataFrame:
    """Each row's features as the array `_own`, and as `_other` those of the row before it in a hash order of about `together`
    rows; the first row gets those of the last, so every value keeps its frequency."""
    groups = max(1, -(-df.count() // together))
    grp = F.pmod(F.xxhash64("game_id", F.lit(seed)), F.lit(groups))
    w = Window.partitionBy("_g").orderBy(F.xxhash64("game_id", F.lit(seed + 1)), "game_id")
    own = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    last = F.last("_own").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn("_own", own).withColumn("_g", grp).withColumn("_other", F.coalesce(F.lag("_own").over(w), last)).drop("_g")


def permutation_importance(predict, df: DataFrame, features: list[str], seed: int = 1, together: int = MIXED_TOGETHER) -> DataFrame:
    """Loss of accuracy per feature when its values are mixed between rows.

    One pass: every row stands once as it is and once per feature with that value taken from its partner, all are scored by
    one plan, and one aggregate gives the accuracies, whose number is that of the features.
    """
    paired = with_partner(df.select("game_id", LABEL, *[F.col(f"`{c}`") for c in features]), features, seed, together)
    variants = paired.select("game_id", LABEL, "_own", "_other", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))).alias("_f"))
    mixed = F.transform("_own", lambda x, i: F.when(i == F.col("_f"), F.get("_other", i)).otherwise(x))
    rows = variants.select("game_id", LABEL, "_f", mixed.alias("_x"))
    rows = rows.select("game_id", LABEL, "_f", *[F.get("_x", F.lit(i)).alias(c) for i, c in enumerate(features)])
    hit = F.avg(flag(F.col("predicted_value") == F.col(LABEL)))
    acc = predict(rows).groupBy("_f").agg(hit.alias("acc"))
    every = acc.agg(F.max(F.when(F.col("_f") == -1, F.col("acc"))).alias("_base"), F.collect_list(F.struct("_f", "acc")).alias("_all"))
    names = F.array(*[F.lit(c) for c in features])
    each = every.select("_base", F.explode("_all").alias("x")).filter("x._f >= 0")
    return each.select(F.element_at(names, F.col("x._f") + 1).alias("feature"), (F.col("_base") - F.col("x.acc")).alias("importance"))


# Reports ------------------------------------------------------------------------------


def prediction_errors(predictions: DataFrame, games: DataFrame) -> DataFrame:
    """Counts of right and wrong predictions, sure but wrong (> 0.7) and unsure but right (< 0.6), per day."""
    j = predictions.join(games.filter("home_score is not null").select("game_id", "game_date", flag(F.col("home_score") > F.col("away_score")).alias("y")), "game_id")
    ok = F.col("predicted_value") == F.col("y")
    return j.groupBy("game_date").agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("correct"), F.count_if(~ok & (F.col("confidence") > 0.7)).alias("sure_wrong"),
                                      F.count_if(ok & (F.col("confidence") < 0.6)).alias("unsure_right"))


def wrong_by_injury(predictions: DataFrame, mart: DataFrame) -> DataFrame:
    """Wrong predictions with their injury ratios; order by `away_ratio` then `home_ratio`, descending."""
    j = predictions.join(mart.select("game_id", "home_win", "home_injury_impact_ratio", "away_injury_impact_ratio", "injury_impact_diff", "win_pct_diff_10"), "game_id")
    return j.filter(F.col("predicted_value") != F.col("home_win")).select(
        "game_id", "confidence", "predicted_value", "home_win", F.abs("home_injury_impact_ratio").alias("home_ratio"), F.abs("away_injury_impact_ratio").alias("away_ratio"),
        "injury_impact_diff", "win_pct_diff_10")


def upset_types(tg: DataFrame) -> DataFrame:
    """Games the weaker side won, judged by win shares before the day."""
    rec = attach(tg, prior_days(tg, ["team_id"], "game_date", [Measure("g", "count", F.lit(1)), Measure("w", "sum", F.col("is_win"))]), ["team_id", "game_date"])
    home = F.col("is_home")
    g = rec.groupBy("game_id", "game_date").agg(
        F.max(F.when(home, ratio("w", "g"))).alias("h"), F.max(F.when(~home, ratio("w", "g"))).alias("a"),
        F.max(F.when(home, F.col("is_win"))).alias("hw"), F.max(F.when(~home, F.col("is_win"))).alias("aw"))
    kind = F.when(F.col("h").isNull() | F.col("a").isNull(), "Unknown").when((F.col("h") < F.col("a")) & (F.col("hw") == 1), "Home Upset").when(
        (F.col("a") < F.col("h")) & (F.col("aw") == 1), "Away Upset").otherwise("Expected")
    return g.select("game_id", "game_date", kind.alias("upset_type"))


def latest_model(registry: DataFrame, name: str | None = None) -> DataFrame:
    """Newest active model per name."""
    r = registry.filter("is_active")
    r = r.filter(F.col("model_name") == name) if name else r
    return r.groupBy("model_name").agg(F.max_by(F.struct("model_id", "model_version"), F.struct("created_at", "model_id")).alias("m")).select("model_name", "m.*")


def compare_versions(predictions: DataFrame, registry: DataFrame) -> DataFrame:
    """Predictions of each version side by side per game: the newest per (game, version), and how far versions disagree."""
    j = predictions.join(registry.select("model_id", "model_version"), "model_id")
    one = j.groupBy("game_id", "model_version").agg(F.max_by(F.struct("predicted_value", "confidence"), "prediction_id").alias("p"))
    return one.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("versions"), F.countDistinct("p.predicted_value").alias("answers"), F.min("p.confidence").alias("min_confidence"), F.max("p.confidence").alias("max_confidence"))


def payout(odds: Column, stake: float = 10.0) -> tuple[Column, Column]:
    """Profit and format: decimal below 10, else American plus or minus."""
    profit = F.when((odds > 0) & (odds < 10), stake * odds - stake).when(odds > 0, stake * odds / 100).otherwise(stake * 100 / F.abs(odds))
    kind = F.when((odds > 0) & (odds < 10), "decimal").when(odds > 0, "american_underdog").otherwise("american_favorite")
    return profit, kind


def latest_odds(odds: DataFrame, market: str = "2way", stake: float = 10.0) -> DataFrame:
    """Newest quote per game in a market, with the profit of a stake on the away side."""
    q = odds.filter((F.col("market_type") == market) & F.col("away_odds").isNotNull())
    top = q.groupBy("game_id").agg(F.max_by(F.struct("book_name", "home_odds", "away_odds"), F.struct("captured_at", "book_name")).alias("o")).select("game_id", "o.*")
    profit, kind = payout(F.col("away_odds"), stake)
    return top.select("*", profit.alias("profit"), kind.alias("odds_format"))


def matchup_report(tg: DataFrame, pair: tuple[int, int], before: str, n: int = 10) -> DataFrame:
    """Last n results of both teams before a day with their record in those games (a top-k report), and all
    meetings of the two before that day with how many each won."""
    rows = tg.filter(F.col("team_id").isin(*pair) & (F.col("game_date") < F.lit(before).cast("date")))
    k = F.row_number().over(Window.partitionBy("team_id").orderBy(F.desc("game_date"), F.desc("game_id")))
    last = rows.withColumn("k", k).filter(F.col("k") <= n)
    day = F.lit(before).cast("date")
    recent = last.groupBy("team_id").agg(
        F.count(F.lit(1)).alias("games"), F.sum("is_win").alias("wins"), F.avg("margin").alias("avg_margin"), F.datediff(day, F.max("game_date")).alias("rest_days"))
    met = rows.filter(F.col("opp_id").isin(*pair)).groupBy("team_id").agg(F.count(F.lit(1)).alias("_met"), F.sum("is_win").alias("_won"))
    return recent.join(met, "team_id", "left").select("*", nvl("_met", 0).alias("head_to_head"), nvl("_won", 0).alias("head_to_head_wins")).drop("_met", "_won")


def key_players(games: DataFrame, box: DataFrame, pair: tuple[int, int], before: str, minutes: float = 30.0) -> DataFrame:
    """Players of both teams with more than `minutes` in a game of the day before."""
    day = F.date_sub(F.lit(before).cast("date"), 1)
    asked = games.filter((F.col("game_date") == day) & (F.col("home_team_id").isin(*pair) | F.col("away_team_id").isin(*pair))).select("game_id")
    long = box.filter(F.col("team_id").isin(*pair) & (F.col("minutes_played") > minutes))
    return long.join(asked, "game_id").select("game_id", "team_id", "player_id", "minutes_played")


def against_history(df: DataFrame, features: list[str], row: DataFrame) -> DataFrame:
    """One row compared with all rows: mean, standard deviation, z-score, extreme beyond 2."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in features], *[F.stddev_samp(c).alias(f"_s_{c}") for c in features])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"), F.col(f"_m_{c}").alias("mean"), F.col(f"_s_{c}").alias("sd")) for c in features])
    x = with_scalars(row, stats).select("game_id", F.explode(items).alias("x")).select("game_id", "x.*")
    z = ratio(F.col("value") - F.col("mean"), "sd")
    return x.withColumn("z", z).withColumn("is_extreme", F.coalesce(F.abs(F.col("z")) > 2, F.lit(False)))


def injury_list(games: DataFrame, reports: DataFrame, players: DataFrame, stars: DataFrame, days: int = 7) -> DataFrame:
    """Reports of both teams in the days up to a game, with tier, newest first by `rank`; returned players left out.

    Reports meet games on (team, day): each report is spread over the days it counts for. All games of a team and day have
    the same list, so it is ranked once per (team, day) and no row of the result is shuffled. Only where a game names a team
    more than once, its lists are ranked together.
    """
    side = F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")
    g = games.select("game_id", "game_date", side).withColumn("_named", F.count(F.lit(1)).over(Window.partitionBy("game_id", "team_id")))
    r = reports.filter(~F.col("status").isin("N/A", "Active")).join(players.select("player_id", "player_name", "team_id"), "player_name")
    r = r.join(stars.select("player_id", "player_tier", "impact_score"), "player_id", "left")
    r = r.withColumn("game_date", F.explode(F.sequence("capture_date", F.date_add("capture_date", days))))
    cols = ["injury_id", "player_id", "status", "player_tier", "impact_score", "capture_date"]
    r = r.select("team_id", "game_date", *cols)

    def rank(*by: str) -> Column:
        order = (F.desc_nulls_last("capture_date"), F.desc_nulls_last("impact_score"), "injury_id")
        return F.row_number().over(Window.partitionBy(*by).orderBy(*order)).alias("rank")

    out = ["game_id", "team_id", *cols]
    once = g.filter("_named = 1").join(r.select("*", rank("team_id", "game_date")), ["team_id", "game_date"]).select(*out, "rank")
    more = g.filter("_named > 1").join(r, ["team_id", "game_date"]).select(*out, rank("game_id", "team_id"))
    return once.unionByName(more)


# Bands of the injury difference, seen from the home side.
BANDS = ((2.0, "Large Home Advantage"), (0.5, "Moderate Home Advantage"), (-0.5, "Neutral"), (-2.0, "Moderate Away Advantage"))


def injury_bands(mart: DataFrame, since: str = "2010-10-01") -> DataFrame:
    """Home wins by band of injury difference."""
    d = F.col("injury_impact_diff")
    band = F.when(d > BANDS[0][0], BANDS[0][1])
    for limit, name in BANDS[1:]:
        band = band.when(d > limit, name)
    rows = mart.filter((F.col("game_date") >= F.lit(since).cast("date")) & (d != 0))
    return rows.groupBy(band.otherwise("Large Away Advantage").alias("injury_advantage")).agg(
        F.count(F.lit(1)).alias("games"), F.sum("home_win").alias("home_wins"), F.avg("home_win").alias("home_win_pct"))


def injury_distribution(mart: DataFrame) -> DataFrame:
    """Coverage and spread of the injury features."""
    h, a = F.col("home_injury_impact_score"), F.col("away_injury_impact_score")
    return mart.agg(
        F.count(F.lit(1)).alias("games"), F.count_if(h > 0).alias("with_home_impact"), F.count_if(a > 0).alias("with_away_impact"), F.count_if(F.col("injury_impact_diff") != 0).alias("with_diff"),
        F.avg(h).alias("avg_home"), F.avg(a).alias("avg_away"), F.stddev_samp(h).alias("sd_home"), F.stddev_samp(a).alias("sd_away"), F.max(h).alias("max_home"), F.max(a).alias("max_away"))
