"""Change of form, matchup style and rest scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import flag, nvl, ratio, with_scalars
from ..operators.entity_rows import to_game_rows
from ..operators.history import Measure, attach, prior_rows, rows_before_day, running
from .context import DAY, split, split_defaults, with_history, with_rest
from .core import ORDER, box_rows
from .registry import Models, model


def _win() -> Column:
    return F.col("is_win")


@model("int_team_form_divergence")
def form_divergence(m: Models) -> DataFrame:
    box = box_rows(m).select("game_id", "game_date", "team_id", "points", "opponent_points", "is_win")
    run = running(box, ["team_id"], *ORDER, sums={
        "p": F.col("points"), "o": F.col("opponent_points"), "w": F.col("is_win"), "n": F.lit(1)})
    run = run.select("game_id", "team_id", "n", ratio("p", "n").alias("s_ppg"), ratio("o", "n").alias("s_opp_ppg"), ratio("w", "n").alias("s_win_pct"))
    rows = m["int_team_rolling_stats"].join(run, ["game_id", "team_id"]).filter("n >= 5")

    def gap(n, k):
        return nvl(F.col(f"rolling_{n}_{k}") - F.col(f"s_{k}"), 0.0)

    out = ["game_id", "team_id", "game_date"]
    for n in (5, 10):
        net = (F.col(f"rolling_{n}_ppg") - F.col(f"rolling_{n}_opp_ppg")) - (F.col("s_ppg") - F.col("s_opp_ppg"))
        out += [*[gap(n, k).alias(f"form_divergence_{k}_{n}") for k in ("win_pct", "ppg", "opp_ppg")], nvl(net, 0.0).alias(f"form_divergence_net_rtg_{n}")]
    out += [F.abs(gap(n, "win_pct")).alias(f"form_divergence_magnitude_win_pct_{n}") for n in (5, 10)]
    out += [flag(F.col("n") >= n).alias(f"has_sufficient_games_{n}") for n in (5, 10)]
    return rows.select(*out)


# Metric -> sign: for what the opponent scores, less is better.
TREND_METRICS = {"win_pct": 1, "net_rtg": 1, "ppg": 1, "off_rtg": 1, "efg_pct": 1, "ts_pct": 1, "opp_ppg": -1, "def_rtg": -1}


def _signed(new: str, old: str, sign: int) -> Column:
    a, b = (new, old) if sign > 0 else (old, new)
    return nvl(F.col(a) - F.col(b), 0.0)


@model("int_team_perf_trends")
def performance_trends(m: Models) -> DataFrame:
    return m["int_team_rolling_stats"].filter("rolling_10_win_pct is not null").select(
        "team_id", "game_date", "game_id",
        *[_signed(f"rolling_5_{k}", f"rolling_10_{k}", s).alias(f"{k}_trend") for k, s in TREND_METRICS.items()])


@model("int_team_recent_momentum")
def recent_momentum(m: Models) -> DataFrame:
    five = m["int_team_rolling_stats"].filter("rolling_5_win_pct is not null").select(
        "game_id", "team_id", *[f"rolling_5_{k}" for k in TREND_METRICS])
    box = box_rows(m).filter("winner_team_id is not null").join(five, ["game_id", "team_id"])

    def three(w):
        f = w(-2, 0)

        def per_100(c):
            return nvl(100.0 * ratio(F.avg(c).over(f), F.avg("possessions").over(f)), 0.0)

        return {
            "rolling_3_win_pct": F.avg("is_win").over(f), "rolling_3_net_rtg": F.avg(F.col("points") - F.col("opponent_points")).over(f),
            "rolling_3_ppg": F.avg("points").over(f), "rolling_3_opp_ppg": F.avg("opponent_points").over(f),
            "rolling_3_off_rtg": per_100("points"), "rolling_3_def_rtg": per_100("opponent_points"),
            "rolling_3_efg_pct": F.avg("efg_pct").over(f), "rolling_3_ts_pct": F.avg("ts_pct").over(f),
        }

    rows = prior_rows(box, ["team_id"], *ORDER, depth=2, exprs=three)
    return rows.select("team_id", "game_date", "game_id", *[
        _signed(f"rolling_3_{k}", f"rolling_5_{k}", s).alias(f"recent_{k}_momentum") for k, s in TREND_METRICS.items()])


def _last_decided(m: Models) -> DataFrame:
    """Side rows of played games with form over the last 3 and 5 decided games before the day."""
    last = rows_before_day(m.decided, ["team_id"], *ORDER, depth=4, probes=m.tg, exprs=lambda w: {
        "w3": F.avg("is_win").over(w(-2, 0)), "w5": F.avg("is_win").over(w(-4, 0)),
        "d3": F.avg("margin").over(w(-2, 0)), "d5": F.avg("margin").over(w(-4, 0))})
    return attach(m.tg.select("game_id", "is_home", "team_id", DAY), last, ["team_id", DAY])


@model("int_team_mom_accel")
def momentum_acceleration(m: Models) -> DataFrame:
    rows = _last_decided(m).select("game_id", "is_home", (nvl("d3", 0.0) - nvl("d5", 0.0)).alias("momentum_acceleration"))
    return to_game_rows(m.played, rows, {"momentum_acceleration": 0.0}, {"momentum_acceleration_diff": "momentum_acceleration"})


@model("int_team_recent_form_trend")
def recent_form_trend(m: Models) -> DataFrame:
    rows = _last_decided(m).select(
        "game_id", "is_home", (nvl("w3", 0.5) - nvl("w5", 0.5)).alias("form_trend_win_pct"),
        (nvl("d3", 0.0) - nvl("d5", 0.0)).alias("form_trend_point_diff"))
    d = {"form_trend_win_pct": 0.0, "form_trend_point_diff": 0.0}
    return to_game_rows(m.played, rows, d, {f"{c}_diff": c for c in d})


@model("int_team_perf_accel")
def performance_acceleration(m: Models) -> DataFrame:
    box = box_rows(m).withColumn("point_diff", F.col("points") - F.col("opponent_points"))
    base = {"win_pct": "is_win", "point_diff": "point_diff", "ppg": "points", "opp_ppg": "opponent_points", "poss": "possessions"}
    rows = prior_rows(box, ["team_id"], *ORDER, depth=6, exprs=lambda w: {
        f"{tag}_{k}": F.avg(c).over(w(lo, hi)) for tag, lo, hi in (("new", -3, -1), ("old", -6, -4)) for k, c in base.items()})

    def gain(k):
        return nvl(F.col(f"new_{k}") - F.col(f"old_{k}"), 0.0)

    def net(tag):
        return nvl(100.0 * ratio(F.col(f"{tag}_ppg") - F.col(f"{tag}_opp_ppg"), f"{tag}_poss"), 0.0)

    return rows.select(
        "team_id", "game_date", "game_id", gain("win_pct").alias("win_pct_acceleration"), gain("point_diff").alias("point_diff_acceleration"),
        gain("ppg").alias("ppg_acceleration"), nvl(F.col("old_opp_ppg") - F.col("new_opp_ppg"), 0.0).alias("defensive_acceleration"),
        (net("new") - net("old")).alias("net_rtg_acceleration"),
        flag(F.col("new_win_pct").isNotNull() & F.col("old_win_pct").isNotNull()).alias("has_acceleration_data"),
    )


@model("int_team_perf_consistency")
def performance_consistency(m: Models) -> DataFrame:
    def over(w, n):
        f = w(-(n - 1), -1)

        def cv(c):
            return nvl(ratio(F.stddev_samp(c).over(f), F.avg(c).over(f)), 0.0)

        spread = {"win_consistency": "is_win", "point_diff_consistency": "margin", "points_consistency": "pts", "opp_points_consistency": "opp_pts"}
        out = {f"{k}_{n}": F.stddev_samp(c).over(f) for k, c in spread.items()}
        return {**out, f"points_cv_{n}": cv("pts"), f"opp_points_cv_{n}": cv("opp_pts")}

    rows = prior_rows(m.tg, ["team_id"], *ORDER, depth=9, exprs=lambda w: {**over(w, 10), **over(w, 5)})
    names = [f"{k}_{n}" for n in (10, 5) for k in (
        "win_consistency", "point_diff_consistency", "points_consistency", "opp_points_consistency", "points_cv", "opp_points_cv")]
    return to_game_rows(m.games, rows, {n: 0.0 for n in names}, {f"{n}_diff": n for n in names})


def medians(df: DataFrame, cols: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Exact medians; equal values are counted first, so the state holds distinct values only.

    The inputs are rounded metrics, which bounds the number of distinct values.
    """
    by = by or []
    parts = []
    for c, name in cols.items():
        counts = df.filter(F.col(c).isNotNull()).groupBy(*by, c).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.groupBy(*by).agg(F.expr(f"percentile({c}, 0.5, n)").alias(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, by) if by else with_scalars(out, p)
    return out


@model("league_recent_form", table=True, whole=True)
def league_recent_form(m: Models) -> DataFrame:
    """One row: league medians over the last 30 days."""
    rolling = m["int_team_rolling_stats"].filter("rolling_10_pace is not null")
    # The league view is the last 30 days before a given day, by default the last day in the data.
    last = m["stg_games"].agg(F.max("game_date").alias("last_day")) if m.as_of is None else None
    if last is None:
        recent = rolling.filter(F.col("game_date") >= F.date_sub(F.lit(m.as_of).cast("date"), 30))
    else:
        recent = with_scalars(rolling, last).filter(F.col("game_date") >= F.date_sub("last_day", 30))
    return medians(recent, {"rolling_10_pace": "med_pace", "rolling_10_off_rtg": "med_off", "rolling_10_def_rtg": "med_def"})


@model("int_team_matchup_perf")
def matchup_style(m: Models) -> DataFrame:
    rows = with_scalars(m["team_game_context"].filter("winner_team_id is not null"), m["league_recent_form"])
    pace, off, dfn = nvl("o_pace10", 95.0), nvl("o_off10", 110.0), nvl("o_def10", 110.0)
    mp, mo, md = nvl("med_pace", 95.0), nvl("med_off", 110.0), nvl("med_def", 110.0)
    styles = {"fast_paced": pace > mp, "slow_paced": pace < mp, "high_scoring": off > mo, "defensive": dfn < md}
    by = ["team_id", "is_home", "yr"]
    last20 = rows_before_day(rows, by, *ORDER, depth=19, probes=m.tg, exprs=lambda w: {
        f"win_pct_vs_{k}": F.avg(F.when(c, _win())).over(w(-19, 0)) for k, c in styles.items()})
    at = attach(m.tg.select("game_id", *by, DAY), last20, [*by, DAY])
    return to_game_rows(m.played, at, {f"win_pct_vs_{k}": 0.5 for k in styles})


@model("int_team_perf_vs_rest_ctx")
def similar_rest_context(m: Models) -> DataFrame:
    def both(cond: str) -> Column:
        return F.expr(cond) & F.expr(cond.replace("rest_days", "o_rest_days").replace("back_to_back", "o_back_to_back"))

    # Both sides in the same rest class: travel, back-to-back, 3+ days, 2 days.
    same = (
        both("back_to_back_with_travel") | (both("back_to_back") & ~F.col("back_to_back_with_travel") & ~F.col("o_back_to_back_with_travel"))
        | both("rest_days >= 3") | both("rest_days = 2") | (both("rest_days <= 1") & both("not back_to_back"))
    )
    rows = with_rest(m).withColumn("same_rest", same)
    # The away side counts what the home side did not win, as the margin is seen from there.
    win = F.when(F.col("is_home"), _win()).otherwise(1 - F.when(F.col("winner_team_id") == F.col("opp_id"), 1).otherwise(0))
    rows = with_history(rows, ["team_id", "is_home"], [
        Measure("w", "sum", F.when(F.col("same_rest"), win)), Measure("similar_rest_game_count", "count", F.when(F.col("same_rest"), 1)),
        Measure("avg_point_diff_vs_similar_rest", "avg", F.when(F.col("same_rest"), F.col("margin")))])
    enough = F.col("similar_rest_game_count") >= 5
    rows = rows.withColumn("win_pct_vs_similar_rest", F.when(enough, ratio("w", "similar_rest_game_count")))
    out = to_game_rows(m.played, rows, {"win_pct_vs_similar_rest": None, "avg_point_diff_vs_similar_rest": 0.0, "similar_rest_game_count": 0},
                       {"win_pct_vs_similar_rest_diff": "win_pct_vs_similar_rest", "avg_point_diff_vs_similar_rest_diff": "avg_point_diff_vs_similar_rest"})
    now = rows.filter("is_home").select("game_id", F.col("same_rest").alias("is_current_game_similar_rest_context"))
    return out.join(now, "game_id", "left").withColumn("is_current_game_similar_rest_context", nvl("is_current_game_similar_rest_context", False))


# Scenario -> which side it favours is read from the side's own rest; names are fixed values.
SCENARIOS = ("well_rested_vs_tired", "well_rested_vs_moderate", "moderate_vs_tired", "with_rest_advantage")


@model("int_team_perf_rest_adv")
def rest_advantage(m: Models) -> DataFrame:
    mine, other = F.col("rest_days"), F.col("o_rest_days")
    tired = F.col("o_back_to_back")
    scenario = (
        F.when((mine >= 3) & tired, SCENARIOS[0]).when((mine >= 3) & (other == 2), SCENARIOS[1])
        .when((mine == 2) & tired, SCENARIOS[2]).when(mine > other, SCENARIOS[3])
    )
    rows = with_rest(m).withColumn("scenario", scenario)
    # Over all earlier games at the same venue, one after the other; a running ratio needs only sums.
    sums = {}
    for s in SCENARIOS:
        on = F.col("scenario") == s
        sums |= {f"n_{s}": flag(on), f"w_{s}": F.when(on, _win()).otherwise(0), f"m_{s}": F.when(on, F.col("margin")).otherwise(0)}
    rows = running(rows, ["team_id", "is_home"], *ORDER, sums=sums)
    cols, d = [], {}
    for s in SCENARIOS:
        cols += [ratio(f"w_{s}", f"n_{s}").alias(f"win_pct_{s}"), ratio(f"m_{s}", f"n_{s}").alias(f"avg_point_diff_{s}"),
                 F.col(f"n_{s}").cast("long").alias(f"{s}_count")]
        d |= {f"win_pct_{s}": 0.5, f"avg_point_diff_{s}": 0.0, f"{s}_count": 0}
    out = to_game_rows(m.played, rows.select("game_id", "is_home", *cols), d, {f"win_pct_{s}_diff": f"win_pct_{s}" for s in SCENARIOS})
    now = rows.groupBy("game_id").agg(*[
        F.max(flag((F.col("scenario") == s) & (F.col("is_home") if s != SCENARIOS[3] else F.lit(True)))).alias(
            "is_rest_advantage_scenario" if s == SCENARIOS[3] else f"is_{s}") for s in SCENARIOS])
    return out.join(now, "game_id", "left")


@model("int_team_perf_by_rest_combo")
def rest_combination(m: Models) -> DataFrame:
    def bucket(c: str) -> Column:
        return F.when(F.col(c) <= 1, "1").when(F.col(c) == 2, "2").otherwise("3")

    b, o = bucket("rest_days"), bucket("o_rest_days")
    rows = with_rest(m).withColumn("combo", F.when(F.col("is_home"), F.concat_ws("_", b, o)).otherwise(F.concat_ws("_", o, b)))
    rows = with_history(rows, ["team_id", "yr", "combo"], split(
        "", F.lit(True), None, ("win_pct_by_rest_combination", "rest_combination_count", "avg_point_diff_by_rest_combination")))
    out = to_game_rows(m.games, rows, {"combo": None, "win_pct_by_rest_combination": 0.5, "avg_point_diff_by_rest_combination": 0.0,
                                       "rest_combination_count": 0},
                       {"rest_combination_win_pct_diff": "win_pct_by_rest_combination",
                        "rest_combination_point_diff_diff": "avg_point_diff_by_rest_combination"})
    return out.withColumnRenamed("home_combo", "rest_combination_key").drop("away_combo")


def steps(gap: Column) -> Column:
    """1 / .75 / .5 / .25 for a gap within 2 / 5 / 10 / beyond."""
    e = 1e-9
    return F.when(gap <= 2.0 + e, 1.0).when(gap <= 5.0 + e, 0.75).when(gap <= 10.0 + e, 0.5).otherwise(0.25)


@model("league_form", table=True, whole=True)
def league_form(m: Models) -> DataFrame:
    """One row: league medians over all different forms."""
    r = m["int_team_rolling_stats"].select("rolling_10_pace", "rolling_10_off_rtg", "rolling_10_def_rtg").na.drop().distinct()
    return medians(r, {"rolling_10_off_rtg": "med_off", "rolling_10_def_rtg": "med_def"})


@model("int_team_matchup_compat")
def matchup_compatibility(m: Models) -> DataFrame:
    rows = with_scalars(m["team_game_context"].filter("is_home"), m["league_form"])
    v = {c: nvl(c, 100.0) for c in ("pace10", "off10", "def10", "o_pace10", "o_off10", "o_def10")}

    def fit(off: Column, dfn: Column) -> Column:
        good, weak = off > F.col("med_off"), dfn < F.col("med_def")
        half = (good & (dfn > F.col("med_def"))) | ((off < F.col("med_off")) & weak)
        return F.when(good & weak, 1.0).when(half, 0.5).otherwise(0.0)

    pace = F.abs(v["pace10"] - v["o_pace10"])
    net = F.abs((v["off10"] - v["def10"]) - (v["o_off10"] - v["o_def10"]))
    h, a = fit(v["off10"], v["o_def10"]), fit(v["o_off10"], v["def10"])
    return rows.select(
        "game_id", "game_date", F.col("team_id").alias("home_team_id"), F.col("opp_id").alias("away_team_id"),
        pace.alias("pace_difference"), steps(pace).alias("pace_compatibility_score"), h.alias("home_off_vs_away_def_compatibility"),
        a.alias("away_off_vs_home_def_compatibility"), (h - a).alias("style_matchup_advantage"), net.alias("net_rtg_difference"),
        steps(net).alias("net_rtg_compatibility_score"),
    )


def game_pace(m: Models) -> DataFrame:
    box = box_rows(m).filter("winner_team_id is not null")
    return box.groupBy("game_id").agg(
        (F.sum("possessions") / 2.0).alias("p"), F.count(F.lit(1)).alias("sides"), F.max("yr").alias("yr")
    ).filter("sides = 2").select("game_id", "yr", F.round("p", 6).alias("p"))


@model("league_pace", table=True, whole=True)
def league_pace(m: Models) -> DataFrame:
    """Median pace of a game, a row per year."""
    return medians(game_pace(m), {"p": "med"}, ["yr"])


@model("int_team_perf_by_pace_ctx")
def pace_context(m: Models) -> DataFrame:
    rows = m.tg.join(game_pace(m).drop("yr"), "game_id", "left").join(F.broadcast(m["league_pace"]), "yr", "left")  # one row per year
    rows = with_history(rows, ["team_id", "yr"], [*split("fast_pace_", F.col("p") > F.col("med")), *split("slow_pace_", F.col("p") <= F.col("med"))])
    return to_game_rows(m.games, rows, split_defaults("fast_pace_", "slow_pace_"))


@model("int_team_perf_after_wl")
def after_wins_losses(m: Models) -> DataFrame:
    rows = prior_rows(m.tg, ["team_id"], *ORDER, depth=1, exprs=lambda w: {
        "prev_won": F.lag(F.when(F.col("winner_team_id").isNotNull(), _win() == 1)).over(w(None, None)),
        "prev_game_margin": F.lag("margin").over(w(None, None))})
    after = {"win": F.col("prev_won"), "loss": ~F.col("prev_won"),
             "big_win": F.col("prev_game_margin") > 10, "big_loss": F.col("prev_game_margin") < -10}
    ms, d = [], {}
    for k, cond in after.items():
        ms += split("", cond, None, (f"win_pct_after_{k}", f"game_count_after_{k}", f"avg_point_diff_after_{k}"))
        d |= {f"win_pct_after_{k}": 0.5, f"avg_point_diff_after_{k}": 0.0, f"game_count_after_{k}": 0}
    rows = with_history(rows, ["team_id"], ms)
    rows = rows.withColumn("is_coming_off_win", flag(F.col("prev_won"))).withColumn("prev_game_margin", F.col("prev_game_margin").cast("double"))
    return to_game_rows(m.played, rows, {**d, "is_coming_off_win": 0, "prev_game_margin": 0.0}, keep=("game_id",))
