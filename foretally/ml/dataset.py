"""Training data: row and column choice, interactions, splits, sample weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import with_scalars
from ..operators.history import ranked

# Columns that are never features.
NOT_FEATURES = ("game_id", "game_date", "home_team_id", "away_team_id", "home_win", "home_score", "away_score", "point_spread",
                "total_points", "is_overtime", "updated_at", "winner_team_id", "is_completed")
FIRST_DAY = "2010-10-01"


def training_rows(mart: DataFrame, since: str = FIRST_DAY, before: str | None = None) -> DataFrame:
    """Decided games from a first day on, before a given day (today by default)."""
    end = F.lit(before).cast("date") if before else F.current_date()
    return mart.filter((F.col("game_date") >= F.lit(since).cast("date")) & (F.col("game_date") < end) & F.col("home_win").isNotNull())


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES]


def dense_rows(df: DataFrame, features: list[str], max_missing: float = 0.15) -> DataFrame:
    """Keep rows with few NULL features; fill the rest with 0 and make all features double."""
    # one flat array, not a sum nested as deep as there are features, which overflows the analyzer's stack
    missing = F.size(F.array_compact(F.array(*[F.when(F.col(c).isNull(), 1) for c in features]))) / F.lit(float(len(features)))
    kept = df.filter(missing <= max_missing)
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def number(c: str) -> Column:
        x = F.col(c)
        if isinstance(kinds[c], T.StringType):
            x = F.when(F.lower(c) == "true", 1.0).when(F.lower(c) == "false", 0.0).otherwise(x.try_cast("double"))
        return F.coalesce(x.cast("double"), F.lit(0.0)).alias(c)

    return kept.select(*[number(c) if c in features else F.col(c) for c in df.columns])


# Published interaction -> (inputs, expression); made only when all inputs exist.
INTERACTIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "momentum_score_diff_x_h2h_win_pct": (("home_momentum_score", "away_momentum_score", "home_h2h_win_pct"), "(home_momentum_score - away_momentum_score) * home_h2h_win_pct"),
    "form_divergence_diff_x_home_advantage": (("home_form_divergence", "away_form_divergence", "home_advantage"), "(home_form_divergence - away_form_divergence) * home_advantage"),
    "momentum_score_diff_x_rest_advantage": (("home_momentum_score", "away_momentum_score", "rest_advantage"), "(home_momentum_score - away_momentum_score) * rest_advantage"),
    "win_pct_diff_10_x_h2h_win_pct": (("win_pct_diff_10", "home_h2h_win_pct"), "win_pct_diff_10 * home_h2h_win_pct"),
    "form_divergence_diff_x_rest_advantage": (("home_form_divergence", "away_form_divergence", "rest_advantage"), "(home_form_divergence - away_form_divergence) * rest_advantage"),
    "injury_impact_diff_x_rest_advantage": (("injury_impact_diff", "rest_advantage"), "injury_impact_diff * rest_advantage"),
    "injury_impact_diff_x_home_advantage": (("injury_impact_diff", "home_advantage"), "injury_impact_diff * home_advantage"),
    "injury_impact_diff_x_win_pct_diff_10": (("injury_impact_diff", "win_pct_diff_10"), "injury_impact_diff * win_pct_diff_10"),
    "form_divergence_diff_x_win_pct_diff_10": (("home_form_divergence", "away_form_divergence", "win_pct_diff_10"), "(home_form_divergence - away_form_divergence) * win_pct_diff_10"),
    "momentum_score_diff_x_win_pct_diff_10": (("home_momentum_score", "away_momentum_score", "win_pct_diff_10"), "(home_momentum_score - away_momentum_score) * win_pct_diff_10"),
    "win_pct_diff_10_x_home_recent_opp_avg_win_pct": (("win_pct_diff_10", "home_recent_opp_avg_win_pct"), "win_pct_diff_10 * home_recent_opp_avg_win_pct"),
    "win_pct_diff_10_x_away_recent_opp_avg_win_pct": (("win_pct_diff_10", "away_recent_opp_avg_win_pct"), "win_pct_diff_10 * away_recent_opp_avg_win_pct"),
    "win_pct_diff_10_x_rest_advantage": (("win_pct_diff_10", "rest_advantage"), "win_pct_diff_10 * rest_advantage"),
    "form_divergence_diff_x_recent_opp_avg_win_pct_diff": (
        ("home_form_divergence", "away_form_divergence", "home_recent_opp_avg_win_pct", "away_recent_opp_avg_win_pct"),
        "(home_form_divergence - away_form_divergence) * (home_recent_opp_avg_win_pct - away_recent_opp_avg_win_pct)"),
    "net_rtg_diff_10_x_home_advantage": (("net_rtg_diff_10", "home_advantage"), "net_rtg_diff_10 * home_advantage"),
    "net_rtg_diff_10_x_rest_advantage": (("net_rtg_diff_10", "rest_advantage"), "net_rtg_diff_10 * rest_advantage"),
    "fg_pct_diff_5_x_win_pct_diff_10": (("fg_pct_diff_5", "win_pct_diff_10"), "fg_pct_diff_5 * win_pct_diff_10"),
    "fg_pct_diff_5_x_rest_advantage": (("fg_pct_diff_5", "rest_advantage"), "fg_pct_diff_5 * rest_advantage"),
    "off_rtg_diff_10_x_def_rtg_diff_10": (("off_rtg_diff_10", "def_rtg_diff_10"), "off_rtg_diff_10 * def_rtg_diff_10"),
}


def with_interactions(df: DataFrame) -> DataFrame:
    """Add the interactions and rate features whose inputs are there and that do not exist yet."""
    have = set(df.columns)
    new = {n: e for n, (need, e) in INTERACTIONS.items() if n not in have and have.issuperset(need)}
    for side in ("home", "away"):
        for n in (5, 10):
            apg, poss, rate = (f"{side}_rolling_{n}_{k}" for k in ("apg", "possessions", "assist_rate"))
            if rate not in have and {apg, poss} <= have:
                new[rate] = f"coalesce(try_divide(100D * {apg}, {poss}), 0D)"
    out = df.selectExpr("*", *[f"{e} as {n}" for n, e in new.items()]) if new else df
    diffs = {f"assist_rate_diff_{n}": f"home_rolling_{n}_assist_rate - away_rolling_{n}_assist_rate" for n in (5, 10)
             if f"assist_rate_diff_{n}" not in have and {f"home_rolling_{n}_assist_rate", f"away_rolling_{n}_assist_rate"} <= set(out.columns)}
    return out.selectExpr("*", *[f"{e} as {n}" for n, e in diffs.items()]) if diffs else out


def hash_share(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and seed only."""
    return F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}"))), 1, 7), 16, 10).cast("long") / float(16**7)


def split_by_day(df: DataFrame, cutoff: str) -> DataFrame:
    """Mark rows before the cut-off day as train, the others as test."""
    return df.withColumn("part", F.when(F.col("game_date") < F.lit(cutoff).cast("date"), "train").otherwise("test"))


def split_by_time(df: DataFrame, test_share: float = 0.2) -> DataFrame:
    """The most recent share of rows is the test part; ties of a day are cut by id.

    Positions come from per-day counts plus the rank inside the day, so there is
    no global sort of the rows.
    """
    pos = ranked(df, [], "game_date", ["game_id"], "_pos").drop("_before", "_in_day")
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    train = F.col("_n") - F.floor(F.col("_n") * test_share)
    return with_scalars(pos, total).withColumn("part", F.when(F.col("_pos") <= train, "train").otherwise("test")).drop("_pos", "_n")


def split_random(df: DataFrame, test_share: float = 0.2, seed: int = 42, names: tuple[str, str] = ("train", "test"), column: str = "part") -> DataFrame:
    """Repeatable random split by key hash; labels spread evenly because the hash ignores them."""
    return df.withColumn(column, F.when(hash_share("game_id", seed) >= test_share, names[0]).otherwise(names[1]))


def boosted_features(features: list[str]) -> list[str]:
    return [c for c in features if "_x_" in c or "_ratio" in c or "injury" in c]


def sample_weights(train: DataFrame, features: list[str], boost: float = 1.5) -> DataFrame:
    """weight = 1 + sum of |x| / max|x| * (boost - 1), scaled to mean 1 and clipped to [0.5, 2]."""
    cols = boosted_features(features)
    if not cols:
        return train.withColumn("weight", F.lit(1.0))
    tops = train.agg(*[F.max(F.abs(c)).alias(f"_m_{c}") for c in cols])
    raw = sum((F.coalesce(F.try_divide(F.abs(c), F.col(f"_m_{c}")), F.lit(0.0)) * (boost - 1.0) for c in cols), F.lit(1.0))
    weighted = with_scalars(train, tops).withColumn("_w", raw).drop(*[f"_m_{c}" for c in cols])
    mean = weighted.agg(F.avg("_w").alias("_mean"))
    w = F.greatest(F.lit(0.5), F.least(F.lit(2.0), F.col("_w") / F.col("_mean")))
    return with_scalars(weighted, mean).withColumn("weight", w).drop("_w", "_mean")
