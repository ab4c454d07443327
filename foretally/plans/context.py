"""How a side did in comparable situations: opponent, venue, rest, margin, phase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import flag, half_up, nvl, ratio, with_scalars
from ..operators.carry import earlier_days
from ..operators.entity_rows import to_game_rows
from ..operators.history import Measure, attach, prior_days, prior_rows, ranked, rows_before_day, running
from .core import ORDER
from .registry import Models, model

DAY = "game_date"


def _win() -> Column:
    return F.col("is_win")


def _decided() -> Column:
    return F.col("winner_team_id").isNotNull()


def split(prefix: str, cond: Column, days: int | None = None, names=("win_pct", "game_count", "avg_point_diff")) -> list[Measure]:
    """Win pct, count and mean margin over the earlier games that meet a condition."""
    pct, n, diff = names
    return [
        Measure(f"{prefix}{pct}", "avg", F.when(cond, _win()), days),
        Measure(f"{prefix}{n}", "count", F.when(cond, 1), days),
        Measure(f"{prefix}{diff}", "avg", F.when(cond, F.col("margin")), days),
    ]


def with_history(rows: DataFrame, by: list[str], measures: list[Measure]) -> DataFrame:
    return attach(rows, prior_days(rows, by, DAY, measures), [*by, DAY])


def split_defaults(*prefixes: str) -> dict[str, object]:
    out: dict[str, object] = {}
    for p in prefixes:
        out |= {f"{p}win_pct": 0.5, f"{p}game_count": 0, f"{p}avg_point_diff": 0.0}
    return out


def with_rest(m: Models) -> DataFrame:
    """Side rows with rest marks of both sides; the first game of a team rests 0 days."""
    cols = {"rest_days": 0, "back_to_back": False, "back_to_back_with_travel": False}
    mine = m["team_rest_rows"].select("game_id", "team_id", *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in cols.items()])
    other = mine.select("game_id", F.col("team_id").alias("opp_id"), *[F.col(c).alias(f"o_{c}") for c in cols])
    return m["team_game_context"].join(mine, ["game_id", "team_id"]).join(other, ["game_id", "opp_id"])


def tier(pct: Column) -> Column:
    return F.when(pct >= 0.6, "top").when(pct >= 0.4, "middle").when(pct < 0.4, "bottom")


def rest_bucket(days: Column, names: tuple[str, str, str]) -> Column:
    """Short (at most 1), two days, longer."""
    return F.when(days <= 1, names[0]).when(days == 2, names[1]).otherwise(names[2])


# Opponent tiers ---------------------------------------------------------------


def _tiered(m: Models) -> DataFrame:
    return m["team_game_context"].withColumn("tier", tier(F.col("o_now10"))).filter("tier is not null")


@model("int_team_opp_tier_perf")
def opponent_tier(m: Models) -> DataFrame:
    rows = with_history(_tiered(m), ["team_id", "is_home", "tier"], split("", F.lit(True), 90))
    rows = rows.select("game_id", "is_home", F.col("win_pct").alias("win_pct_vs_opponent_tier"),
                       F.col("avg_point_diff").alias("avg_point_diff_vs_opponent_tier"),
                       F.col("game_count").alias("game_count_vs_opponent_tier"))
    return to_game_rows(
        m.games, rows,
        {"win_pct_vs_opponent_tier": 0.5, "avg_point_diff_vs_opponent_tier": 0.0, "game_count_vs_opponent_tier": 0},
        {f"{c}_diff": c for c in ("win_pct_vs_opponent_tier", "avg_point_diff_vs_opponent_tier")},
    )


@model("int_team_opp_tier_ha")
def opponent_tier_home_away(m: Models) -> DataFrame:
    ms, d = [], {}
    for place, cond in (("at_home", F.col("is_home")), ("on_road", ~F.col("is_home"))):
        names = tuple(f"{n}_vs_opponent_tier_{place}" for n in ("win_pct", "game_count", "avg_point_diff"))
        ms += split("", cond, 90, names)
        d |= {names[0]: 0.5, names[2]: 0.0, names[1]: 0}
    out = to_game_rows(m.games, with_history(_tiered(m), ["team_id", "tier"], ms), d)
    for c in ("win_pct", "avg_point_diff"):
        out = out.withColumn(f"{c}_vs_opponent_tier_home_away_diff",
                             F.col(f"home_{c}_vs_opponent_tier_at_home") - F.col(f"away_{c}_vs_opponent_tier_on_road"))
    return out


@model("int_team_perf_vs_opp_qual_rest")
def opponent_quality_by_rest(m: Models) -> DataFrame:
    strong = F.col("o_wp10") > 0.5
    rows = with_rest(m).withColumn("rest_bucket", rest_bucket(F.col("rest_days"), ("back_to_back", "2_days", "well_rested")))
    ms = []
    for name, cond in (("strong", nvl(strong, False)), ("weak", ~nvl(strong, False))):
        ms += [Measure(f"win_pct_vs_{name}_by_rest", "avg", F.when(cond, _win())),
               Measure(f"games_vs_{name}_by_rest", "count", F.when(cond, 1))]
    rows = with_history(rows, ["team_id", "is_home", "yr", "rest_bucket"], ms)
    return to_game_rows(m.played, rows, {
        "rest_bucket": None, "win_pct_vs_strong_by_rest": 0.5, "games_vs_strong_by_rest": 0,
        "win_pct_vs_weak_by_rest": 0.5, "games_vs_weak_by_rest": 0,
    })


# Similar opponents ---------------------------------------------------------------


def _similar(m: Models, rows: DataFrame, n: int, diff: Column, names: tuple[str, str, str], current: str) -> DataFrame:
    """Last n earlier games that were also similar, given when today's game is."""
    like = prior_rows(rows.filter("similar = 1"), ["team_id"], *ORDER, depth=n, exprs=lambda w: {
        names[0]: F.avg("is_win").over(w(-n, -1)), names[1]: F.avg(diff).over(w(-n, -1)),
        names[2]: F.count(F.lit(1)).over(w(-n, -1)).cast("int"),
    }).select("game_id", "is_home", *names)
    out = to_game_rows(m.played, like, {names[0]: 0.5, names[1]: 0.0, names[2]: 0})
    home = rows.filter("is_home").select("game_id", F.col("score").alias(current))
    return out.join(home, "game_id", "left").withColumn(current, nvl(current, 0.5 if current.endswith("score") else 0))


@model("int_team_perf_vs_similar_qual")
def similar_quality(m: Models) -> DataFrame:
    near = (F.abs(nvl("wp10", 0.5) - nvl("o_wp10", 0.5)) <= 0.1 + 1e-9) | (F.abs(nvl("nr10", 0.0) - nvl("o_nr10", 0.0)) <= 3.0 + 1e-9)
    rows = m["team_game_context"].filter(_decided()).withColumn("similar", flag(near)).withColumn("score", F.col("similar"))
    return _similar(m, rows, 10, F.col("margin"), ("win_pct_vs_similar_quality", "avg_point_diff_vs_similar_quality", "similar_quality_game_count"),
                    "is_current_game_similar_quality")


@model("int_team_perf_vs_similar_mom")
def similar_momentum(m: Models) -> DataFrame:
    near = (F.abs(nvl("wp5", 0.5) - nvl("o_wp5", 0.5)) <= 0.15 + 1e-9) | (F.abs(nvl("nr5", 0.0) - nvl("o_nr5", 0.0)) <= 4.0 + 1e-9)
    rows = m["team_game_context"].filter(_decided()).withColumn("similar", flag(near)).withColumn("score", F.col("similar"))
    return _similar(m, rows, 10, F.col("margin"), ("win_pct_vs_similar_momentum", "avg_point_diff_vs_similar_momentum", "similar_momentum_game_count"),
                    "is_current_game_similar_momentum")


@model("int_team_opp_similarity_perf")
def opponent_similarity(m: Models) -> DataFrame:
    # Defaults without history, and the scale all three are divided by.
    base = {"pace10": 95.0, "off10": 110.0, "def10": 110.0}
    gap = sum((F.pow((nvl(c, v) - nvl(f"o_{c}", v)) / 20.0, 2) for c, v in base.items()), F.lit(0.0))
    score = 1.0 / (1.0 + F.sqrt(gap))
    rows = m["team_game_context"].filter(_decided()).withColumn("score", score)
    rows = rows.withColumn("similar", flag(F.col("score") > 0.7))
    proxy = F.when(F.col("is_win") == 1, 5.0).otherwise(-5.0)
    return _similar(m, rows, 15, proxy, ("win_pct_vs_similar_opponents", "avg_point_diff_vs_similar_opponents", "similar_opponent_game_count"),
                    "current_game_similarity_score")


@model("int_team_quality_adj_perf")
def quality_adjusted(m: Models) -> DataFrame:
    rows = m["team_game_context"]
    item = F.struct(F.col(DAY).alias("d"), F.col("is_win").alias("w"), F.col("margin").cast("double").alias("m"), F.col("o_now10").alias("s"))
    last = rows_before_day(rows.filter("o_now10 is not null"), ["team_id"], *ORDER, depth=9,
                           exprs=lambda w: {"recent": F.collect_list(item).over(w(-9, 0))},
                           probes=rows)
    at = attach(rows.select("game_id", "is_home", "team_id", DAY), last, ["team_id", DAY])

    # One pass over each short list collects the sums all figures come from.
    parts = ("ws", "ls", "wm", "lm", "wn", "ln")
    for n, days in ((5, 30), (10, 60)):
        fresh = f"filter(recent, x -> datediff({DAY}, x.d) <= {days})"
        xs = f"slice({fresh}, greatest(size({fresh}) - {n - 1}, 1), {n})"
        zero = "named_struct(" + ", ".join(f"'{p}', 0D" for p in parts) + ")"
        step = ("named_struct('ws', a.ws + if(x.w = 1, x.s, 0D), 'ls', a.ls + if(x.w = 0, x.s, 0D), 'wm', a.wm + if(x.w = 1, x.m, 0D), "
                "'lm', a.lm + if(x.w = 0, x.m, 0D), 'wn', a.wn + if(x.w = 1, 1D, 0D), 'ln', a.ln + if(x.w = 0, 1D, 0D))")
        at = at.withColumn(f"_t{n}", F.expr(f"aggregate({xs}, {zero}, (a, x) -> {step})"))
    cols = []
    for n in (5, 10):
        t = {p: f"_t{n}.{p}" for p in parts}
        both_s, both_n = f"{t['ws']} + {t['ls']}", f"{t['wn']} + {t['ln']}"
        cols += [
            f"try_divide({t['ws']}, {t['wn']}) as avg_opponent_strength_in_wins_{n}", f"try_divide({t['ls']}, {t['ln']}) as avg_opponent_strength_in_losses_{n}",
            f"try_divide({both_s}, {both_n}) as avg_opponent_strength_{n}", f"try_divide({t['ws']}, {both_s}) as quality_adjusted_win_pct_{n}",
            f"try_divide({t['wm']}, {t['wn']}) as avg_point_diff_in_wins_{n}", f"try_divide({t['lm']}, {t['ln']}) as avg_point_diff_in_losses_{n}",
            f"cast({t['wn']} as int) as wins_count_{n}", f"cast({t['ln']} as int) as losses_count_{n}", f"cast({both_n} as int) as total_games_{n}"]
    d: dict[str, object] = {}
    for n in (5, 10):
        d |= {f"avg_opponent_strength_in_wins_{n}": 0.5, f"avg_opponent_strength_in_losses_{n}": 0.5, f"avg_opponent_strength_{n}": 0.5,
              f"quality_adjusted_win_pct_{n}": 0.5, f"avg_point_diff_in_wins_{n}": 0.0, f"avg_point_diff_in_losses_{n}": 0.0,
              f"wins_count_{n}": 0, f"losses_count_{n}": 0, f"total_games_{n}": 0}
    return to_game_rows(m.games, at.selectExpr("game_id", "is_home", *cols), d, {
        f"{c}_diff_{n}": f"{c}_{n}" for c in ("quality_adjusted_win_pct", "avg_opponent_strength") for n in (5, 10)
    })


@model("int_team_recent_perf_wt_opp_qual")
def quality_weighted_recent(m: Models) -> DataFrame:
    rows = m["team_game_context"].filter(_decided()).select(
        "*", nvl("o_wp10", 0.5).alias("s"), F.abs(nvl("o_nr10", 0.0)).alias("r"))

    def over(w, n):
        def weighted_mean(x: Column, wt: str):
            return ratio(F.sum(x * F.col(wt)).over(w(-n, -1)), F.sum(wt).over(w(-n, -1)))

        return {f"weighted_win_pct_{n}": weighted_mean(F.col("is_win"), "s"),
                f"weighted_point_diff_{n}": weighted_mean(F.col("margin"), "s"),
                f"weighted_net_rtg_{n}": weighted_mean(F.col("margin"), "r")}

    out = prior_rows(rows, ["team_id"], *ORDER, depth=10, exprs=lambda w: {**over(w, 5), **over(w, 10)})
    d = {f"weighted_{c}_{n}": v for c, v in (("win_pct", 0.5), ("point_diff", 0.0), ("net_rtg", 0.0)) for n in (5, 10)}
    return to_game_rows(m.played, out, d, {f"weighted_{c}_diff_{n}": f"weighted_{c}_{n}" for c in ("win_pct", "point_diff", "net_rtg") for n in (5, 10)})


# Venue -----------------------------------------------------------------------------


@model("int_team_home_road_perf")
def home_road(m: Models) -> DataFrame:
    rows = with_history(m.tg, ["team_id", "is_home", "yr"], [Measure("pct", "avg", _win())])
    out = to_game_rows(m.games, rows, {"pct": 0.5}, {"home_advantage": "pct"})
    return out.withColumnsRenamed({"home_pct": "home_home_win_pct", "away_pct": "away_road_win_pct"})


@model("int_team_home_away_opp_qual")
def home_away_opponent_quality(m: Models) -> DataFrame:
    strong = nvl(F.col("o_wp10") > 0.5, False)
    rows = with_history(m["team_game_context"], ["team_id", "is_home", "yr"], [
        Measure("win_pct_vs_strong", "avg", F.when(strong, _win())), Measure("win_pct_vs_weak", "avg", F.when(~strong, _win())),
    ])
    return to_game_rows(m.games, rows, {"win_pct_vs_strong": 0.5, "win_pct_vs_weak": 0.5})


@model("int_team_home_away_rest_perf")
def home_away_rest(m: Models) -> DataFrame:
    rows = with_rest(m).withColumn("bucket", rest_bucket(F.col("rest_days"), ("btb", "2days", "3plus")))
    rows = with_history(rows, ["team_id", "is_home", "yr", "bucket"], [Measure("win_pct_by_rest_bucket", "avg", _win())])
    return to_game_rows(m.games, rows, {"win_pct_by_rest_bucket": 0.5}, {"rest_bucket_win_pct_diff": "win_pct_by_rest_bucket"})


@model("int_team_road_perf")
def recent_road(m: Models) -> DataFrame:
    away = m.tg.filter(~F.col("is_home"))
    last = rows_before_day(away, ["team_id"], *ORDER, depth=9, exprs=lambda w: {
        k: c for n in (5, 10) for k, c in {
            f"p{n}": F.avg("is_win").over(w(-(n - 1), 0)), f"c{n}": F.count(F.lit(1)).over(w(-(n - 1), 0)),
            f"d{n}": F.avg("margin").over(w(-(n - 1), 0)),
        }.items()
    })
    rows = attach(away, last, ["team_id", DAY])
    out = m.played.select("game_id", DAY, "home_team_id", "away_team_id").join(
        rows.select("game_id", *[f"{k}{n}" for n in (5, 10) for k in "pcd"]), "game_id", "left")
    cols = []
    for n, least in ((5, 3), (10, 5)):
        cols += [F.when(F.col(f"c{n}") >= least, F.col(f"p{n}")).otherwise(0.5).alias(f"away_recent_road_win_pct_{n}"),
                 nvl(f"c{n}", 0).alias(f"away_recent_road_game_count_{n}"),
                 nvl(f"d{n}", 0.0).alias(f"away_recent_road_avg_point_diff_{n}")]
    return out.select("game_id", DAY, "home_team_id", "away_team_id", *cols)


# Margin and game type -----------------------------------------------------------------


@model("int_team_clutch_perf")
def clutch(m: Models) -> DataFrame:
    close = _decided() & (F.abs("margin") <= 5)
    return to_game_rows(m.games, with_history(m.tg, ["team_id", "yr"], split("clutch_", close)), split_defaults("clutch_"))


@model("int_team_blowout_perf")
def blowout(m: Models) -> DataFrame:
    big = _decided() & (F.abs("margin") > 15)
    rows = with_history(m.tg, ["team_id"], [
        *split("blowout_", big, 90), Measure("blowout_frequency", "avg", F.when(_decided(), flag(big)), 90)])
    return to_game_rows(m.games, rows, {**split_defaults("blowout_"), "blowout_frequency": 0.0})


@model("int_team_cb_closeout_perf")
def comeback_closeout(m: Models) -> DataFrame:
    rows = with_history(m.tg, ["team_id"], [
        *split("comeback_", _decided() & (F.abs("margin") <= 5), 90), *split("closeout_", _decided() & (F.abs("margin") > 10), 90)])
    return to_game_rows(m.games, rows, split_defaults("comeback_", "closeout_"))


@model("int_team_ot_perf")
def overtime(m: Models) -> DataFrame:
    ot = F.col("is_overtime")
    # A tied overtime game counts as played but is neither won nor lost.
    ms = [Measure("overtime_win_pct", "avg", F.when(ot & _decided(), _win())), *split("overtime_", ot)[1:]]
    return to_game_rows(m.played, with_history(m.tg, ["team_id", "yr"], ms), split_defaults("overtime_"))


@model("int_team_4q_perf")
def fourth_quarter(m: Models) -> DataFrame:
    q = m["raw_team_boxscores"].select("game_id", "team_id", "q4_points").filter("q4_points is not null")
    other = m["raw_team_boxscores"].select("game_id", F.col("team_id").alias("opp_id"), F.col("q4_points").alias("opp_q4"))
    rows = m.decided.join(q, ["game_id", "team_id"]).join(other, ["game_id", "opp_id"], "left")
    net = F.col("q4_points") - nvl("opp_q4", 0)
    rows = rows.withColumn("q4_net_rating", net).withColumn("won_q4", flag(net > 0))
    rows = running(rows, ["team_id"], *ORDER, sums={
        "q4_wins_count_season": F.col("won_q4"), "both": F.col("won_q4") * F.col("is_win")}, inclusive=True)
    rows = prior_rows(rows, ["team_id"], *ORDER, depth=9, exprs=lambda w: {
        k: c for n in (5, 10) for k, c in {
            f"rolling_{n}_q4_ppg": F.avg("q4_points").over(w(-(n - 1), 0)),
            f"rolling_{n}_q4_net_rtg": F.avg("q4_net_rating").over(w(-(n - 1), 0)),
            f"rolling_{n}_q4_win_pct": F.avg("won_q4").over(w(-(n - 1), 0)),
        }.items()
    })
    return rows.select(
        "team_id", DAY, "game_id", "is_home", "q4_points", "q4_net_rating", "won_q4",
        *[f"rolling_{n}_q4_{k}" for n in (5, 10) for k in ("ppg", "net_rtg", "win_pct")],
        nvl(ratio("both", "q4_wins_count_season"), 0.5).alias("season_q4_win_pct_when_won_q4"),
        F.col("q4_wins_count_season").cast("long").alias("q4_wins_count_season"),
    )


@model("int_team_outcome_qual")
def outcome_quality(m: Models) -> DataFrame:
    gap = F.abs("margin")
    win = F.col("is_win") == 1

    def over(w, n):
        f = w(-n, -1)
        return {
            f"avg_margin_in_wins_{n}": F.avg(F.when(win, gap)).over(f), f"avg_margin_in_losses_{n}": F.avg(F.when(~win, gap)).over(f),
            f"close_game_win_pct_{n}": F.avg(F.when(gap <= 5, _win())).over(f),
            f"blowout_game_win_pct_{n}": F.avg(F.when(gap > 15, _win())).over(f),
        }

    rows = prior_rows(m.decided, ["team_id"], *ORDER, depth=10, exprs=lambda w: {**over(w, 5), **over(w, 10)})
    d = {f"{c}_{n}": v for n in (5, 10) for c, v in (
        ("avg_margin_in_wins", 0.0), ("avg_margin_in_losses", 0.0), ("close_game_win_pct", 0.5), ("blowout_game_win_pct", 0.5))}
    return to_game_rows(m.played, rows, d)


# Favourites and underdogs ---------------------------------------------------------------


@model("int_team_upset_resistance")
def upset_resistance(m: Models) -> DataFrame:
    fav, dog = _decided() & (F.col("now10") > F.col("o_now10")), _decided() & (F.col("now10") < F.col("o_now10"))
    ms = []
    for name, cond in (("favorite", fav), ("underdog", dog)):
        ms += [Measure(f"{name}_win_pct", "avg", F.when(cond, _win())), Measure(f"{name}_game_count", "count", F.when(cond, 1))]
    rows = with_history(m["team_game_context"], ["team_id", "yr"], ms)
    rows = rows.withColumn("upset_resistance_score", (F.col("favorite_win_pct") - 0.5) + (F.col("underdog_win_pct") - 0.3))
    return to_game_rows(m.games, rows, {"favorite_win_pct": 0.5, "favorite_game_count": 0, "underdog_win_pct": 0.3,
                                        "underdog_game_count": 0, "upset_resistance_score": 0.0})


@model("int_team_favored_underdog_perf")
def favored_underdog(m: Models) -> DataFrame:
    fav, dog = _decided() & (F.col("wp10") > F.col("o_wp10")), _decided() & (F.col("wp10") < F.col("o_wp10"))
    upset = _decided() & (F.col("o_wp10") - F.col("wp10") > 0.2 + 1e-9)
    rows = with_history(m["team_game_context"], ["team_id"], [
        *split("", fav, 90, ("win_pct_when_favored", "favored_game_count", "avg_point_diff_when_favored")),
        *split("", dog, 90, ("win_pct_when_underdog", "underdog_game_count", "avg_point_diff_when_underdog")),
        Measure("upset_rate", "avg", F.when(upset, _win()), 90), Measure("upset_game_count", "count", F.when(upset, 1), 90),
    ])
    return to_game_rows(m.games, rows, {
        "win_pct_when_favored": 0.5, "favored_game_count": 0, "win_pct_when_underdog": 0.5, "underdog_game_count": 0,
        "avg_point_diff_when_favored": 0.0, "avg_point_diff_when_underdog": 0.0, "upset_rate": 0.0, "upset_game_count": 0,
    })


# Season phase and standings ----------------------------------------------------------------

# Game numbers (from, to] of each phase.
PHASES = {"early_season": (0, 20), "mid_season": (20, 60), "late_season": (60, 82), "playoff_push": (72, 82)}


@model("int_team_timing_perf")
def season_timing(m: Models) -> DataFrame:
    by = ["season", "team_id", "is_home"]
    rows = ranked(m.decided, by, DAY, ["game_id"], "num")
    ms, d = [], {}
    for p, (lo, hi) in PHASES.items():
        inside = (F.col("num") > lo) & (F.col("num") <= hi)
        rows = rows.withColumn(f"is_{p}", flag(inside))
        ms += split(f"{p}_", inside)
        d |= split_defaults(f"{p}_")
    d |= {f"is_{p}": 0 for p in PHASES}
    finished = m.played.filter("winner_team_id is not null")
    diffs = {f"{p}_{c}_diff": f"{p}_{c}" for p in PHASES for c in ("win_pct", "avg_point_diff")}
    out = to_game_rows(finished, with_history(rows, by, ms), d, diffs)
    return out.withColumnsRenamed({f"{s}_is_{p}": f"is_{s}_{p}" for s in ("home", "away") for p in PHASES})


@model("int_team_playoff_ctx", table=True)
def playoff_race(m: Models) -> DataFrame:
    """Standings of every team that has played, on every game day.

    Results shrink to one row per (team, day) first; the spine of days x teams
    has that size too, and the running totals see one row per day.
    """
    lost = _decided() & (F.col("is_win") == 0)
    daily = m.tg.groupBy("team_id", DAY).agg(
        F.sum("is_win").alias("w"), F.sum(flag(lost)).alias("l"), F.count(F.lit(1)).alias("g"))
    # In a run by chunks each team's record so far is one more row on the day before the chunk.
    daily = earlier_days(daily, ["team_id"], DAY, {"w": "sum", "l": "sum", "g": "sum"})
    # Every day from a team's first game on, kept where somebody played: days per team, no product of tables.
    span = daily.groupBy("team_id").agg(F.min(DAY).alias("first_day"))
    last = daily.agg(F.max(DAY).alias("last_day"))
    spine = with_scalars(span, last).select("team_id", F.explode(F.sequence("first_day", "last_day")).alias(DAY)).join(
        daily.select(DAY).distinct(), DAY, "left_semi")
    upto = Window.partitionBy("team_id").orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
    table = spine.join(daily, ["team_id", DAY], "left").select(
        "team_id", DAY, *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(upto).alias(n) for c, n in (("w", "wins"), ("l", "losses"), ("g", "games"))])
    table = table.withColumn("win_pct", half_up(ratio("wins", "games"), 3))
    by_day = Window.partitionBy(DAY)
    order = by_day.orderBy(F.desc("win_pct"), F.desc("wins"), "team_id")
    table = table.withColumn("overall_rank", F.row_number().over(order))
    at16 = F.col("overall_rank") == 16
    table = table.withColumn("cut_pct", nvl(F.max(F.when(at16, F.col("win_pct"))).over(by_day), 0.0)).withColumn(
        "cut_wins", nvl(F.max(F.when(at16, F.col("wins"))).over(by_day), 0))
    back = F.greatest(F.lit(0).cast("long"), F.col("cut_wins") - F.col("wins"))
    return table.select(
        DAY, "team_id", "overall_rank", flag(F.col("overall_rank") <= 16).alias("is_in_playoff_position"),
        back.alias("games_back_from_cutoff"), (F.col("win_pct") - F.col("cut_pct")).alias("win_pct_diff_from_cutoff"),
        flag(back <= 3).alias("is_close_to_cutoff"), flag(F.col("overall_rank").between(12, 20)).alias("is_fighting_for_playoff_spot"),
    )

