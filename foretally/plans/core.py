"""Core team history: rolling form, lookups, season totals, streaks, rest, pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import flag, half_up, half_up_sql, nvl, ratio
from ..operators.asof import asof_day
from ..operators.entity_rows import to_game_rows
from ..operators.history import Measure, attach, decayed, prior_days, prior_rows, rows_before_day, running, weighted
from ..operators.pairs import with_pair
from ..operators.streaks import streak_before
from .registry import Models, model, one_key_enough

ORDER = ("game_date", ["game_id"])

# Digits kept per rolling metric.
ROLLING_DIGITS = {
    "ppg": 1, "opp_ppg": 1, "win_pct": 3, "apg": 1, "rpg": 1, "fg_pct": 3, "fg3_pct": 3, "efg_pct": 3, "ts_pct": 3,
    "possessions": 1, "off_rtg": 1, "def_rtg": 1, "net_rtg": 1, "pace": 1, "tov_rate": 2, "assist_rate": 2,
    "steal_rate": 2, "block_rate": 2, "ppg_stddev": 1, "opp_ppg_stddev": 1, "ppg_cv": 3, "opp_ppg_cv": 3,
}


def possessions() -> Column:
    return F.col("fg_attempted") + 0.44 * F.col("ft_attempted") + F.col("turnovers")


@model("team_box_rows", table=True)
def team_box_rows(m: Models) -> DataFrame:
    """Team box scores of played games with the result and the shooting ratios; written once, eight models read it."""
    box = m["stg_team_boxscores"].drop("game_date", "is_home")
    sides = m.tg.select(
        "game_id", "game_date", "season", "yr", "team_id", "opp_id", "is_home", "winner_team_id", "is_overtime",
        "is_win", F.col("opp_pts").alias("opponent_points"),
    )
    shots = F.col("fg_attempted") + 0.44 * F.col("ft_attempted")
    return sides.join(box, ["game_id", "team_id"]).select(
        "*",
        nvl(ratio(F.col("fg_made") + 0.5 * F.col("fg3_made"), "fg_attempted"), 0.0).alias("efg_pct"),
        nvl(ratio("points", 2.0 * shots), 0.0).alias("ts_pct"),
        possessions().alias("possessions"),
    )


def box_rows(m: Models) -> DataFrame:
    return m["team_box_rows"]


# Averages a frame needs, each computed once; the metrics are ratios of them.
_AVERAGED = {"ppg": "points", "opp_ppg": "opponent_points", "win_pct": "is_win", "apg": "assists", "rpg": "rebounds", "fg_pct": "fg_pct",
             "fg3_pct": "fg3_pct", "efg_pct": "efg_pct", "ts_pct": "ts_pct", "possessions": "possessions", "tov": "turnovers",
             "spg": "steals", "bpg": "blocks"}


def rolling_sums(w, n: int) -> dict[str, Column]:
    """Plain window aggregates over the n rows before the current one."""
    f = w(-n, -1)
    out = {f"_{n}_{k}": F.avg(c).over(f) for k, c in _AVERAGED.items()}
    out |= {f"_{n}_{k}_stddev": F.stddev_samp(c).over(f) for k, c in (("ppg", "points"), ("opp_ppg", "opponent_points"))}
    out[f"wins_last_{n}"] = F.sum("is_win").over(f)
    out[f"games_in_{n}_window"] = F.count(F.lit(1)).over(f)
    return out


def rolling_metrics(n: int) -> list[str]:
    """The published metrics as expression text over the window aggregates."""
    def a(k: str) -> str:
        return f"_{n}_{k}"

    def per_100(x: str) -> str:
        return f"case when {a('possessions')} > 0 then 100D * ({x}) / {a('possessions')} else 0D end"

    def cv(k: str) -> str:
        return f"case when {a(k)} > 0 then {a(k)}_stddev / {a(k)} else 0D end"

    special = {
        "pace": a("possessions"), "off_rtg": per_100(a("ppg")), "def_rtg": per_100(a("opp_ppg")), "net_rtg": per_100(f"{a('ppg')} - {a('opp_ppg')}"),
        "tov_rate": per_100(a("tov")), "assist_rate": per_100(a("apg")), "steal_rate": per_100(a("spg")), "block_rate": per_100(a("bpg")),
        "ppg_cv": cv("ppg"), "opp_ppg_cv": cv("opp_ppg"),
    }
    rounded = [f"{half_up_sql('(' + special.get(k, a(k)) + ')', d)} as rolling_{n}_{k}" for k, d in ROLLING_DIGITS.items()]
    return [*rounded, f"wins_last_{n}", f"games_in_{n}_window"]


def rolling_rows(m: Models) -> DataFrame:
    """Rolling form of every team before each game; a reader that selects columns has only those computed."""
    rows = prior_rows(
        box_rows(m), ["team_id"], *ORDER, depth=10, exprs=lambda w: {**rolling_sums(w, 5), **rolling_sums(w, 10)}, keep_rank=True)
    return rows.filter("_rn > 5").selectExpr(
        "team_id", "game_date", "game_id", "_rn as game_num", "is_home", "points", "opponent_points",
        "case when winner_team_id is not null then is_win = 1 end as is_win", *rolling_metrics(5), *rolling_metrics(10))


@model("int_team_rolling_stats", table=True)
def team_rolling_stats(m: Models) -> DataFrame:
    return rolling_rows(m)


def lookup_columns() -> list[str]:
    """Rolling columns carried by the lookup: all of 5 games, the rates of 10."""
    five = [f"rolling_5_{k}" for k in ROLLING_DIGITS]
    ten = [f"rolling_10_{k}" for k in ROLLING_DIGITS if k not in ("apg", "rpg", "fg_pct", "fg3_pct")]
    return [*five, "wins_last_5", *ten, "wins_last_10"]


@model("int_team_roll_lkp")
def team_roll_lookup(m: Models) -> DataFrame:
    asked = m.tg.select("game_id", "game_date", "team_id")
    cols = lookup_columns()
    found = asof_day(asked, m["int_team_rolling_stats"], ["team_id"], "game_date", cols, ["game_id"], place="game_num")
    return found.select("game_id", "game_date", "team_id", *cols)


# Metrics of both sides that the opponent models compare.
_CONTEXT = {
    "rolling_5_win_pct": "wp5", "rolling_10_win_pct": "wp10", "rolling_5_net_rtg": "nr5", "rolling_10_net_rtg": "nr10",
    "rolling_10_pace": "pace10", "rolling_10_off_rtg": "off10", "rolling_10_def_rtg": "def10",
}


@model("team_form", table=True)
def team_form(m: Models) -> DataFrame:
    """The few rolling metrics that the opponent models compare: neither the forty others nor their lookup are made for them."""
    return rolling_rows(m).select("game_id", "team_id", "game_date", "game_num", *_CONTEXT)


@model("team_game_context")
def team_game_context(m: Models) -> DataFrame:
    """Side rows with own and opponent (`o_`) as-of form, and the rolling pct of the game's own row; written here."""
    def by_game(df: DataFrame) -> DataFrame:
        return df.repartition("game_id")

    asked = m.tg.select("game_id", "game_date", "team_id")
    lkp = asof_day(asked, m["team_form"], ["team_id"], "game_date", list(_CONTEXT), ["game_id"], place="game_num").select(
        "game_id", "team_id", *[F.col(c).alias(a) for c, a in _CONTEXT.items()])
    now = m["team_form"].select("game_id", "team_id", F.col("rolling_10_win_pct").alias("now10"))
    mine = by_game(lkp).join(by_game(now), ["game_id", "team_id"], "left")
    other = mine.select("game_id", F.col("team_id").alias("opp_id"), *[
        F.col(c).alias(f"o_{c}") for c in [*_CONTEXT.values(), "now10"]
    ])
    rows = by_game(m.tg).join(mine, ["game_id", "team_id"], "left").join(other, ["game_id", "opp_id"], "left")
    # both sides of a game lie together, so all joins here work on one exchange by game
    with one_key_enough(m.spark):
        return m.written(rows, "team_game_context")


@model("int_team_season_stats", table=True, whole=True)
def team_season_stats(m: Models) -> DataFrame:
    win, home = F.col("is_win") == 1, F.col("is_home")
    lost = F.col("winner_team_id").isNotNull() & (F.col("is_win") == 0)

    def n(cond):
        return F.sum(flag(cond)).cast("long")

    def mean(c, digits=1):
        return half_up(F.avg(c), digits)

    def share(a, b):
        return half_up(ratio(F.sum(a), F.sum(b)), 3)

    return box_rows(m).groupBy("team_id").agg(
        F.count(F.lit(1)).alias("games_played"), n(win).alias("wins"), n(lost).alias("losses"),
        half_up(ratio(F.sum("is_win"), F.count(F.lit(1))), 3).alias("win_pct"),
        n(home & win).alias("home_wins"), n(home & lost).alias("home_losses"),
        n(~home & win).alias("away_wins"), n(~home & lost).alias("away_losses"),
        mean("points").alias("ppg"), mean("opponent_points").alias("opp_ppg"),
        half_up(F.avg("points") - F.avg("opponent_points"), 1).alias("point_diff"),
        mean("assists").alias("apg"), mean("rebounds").alias("rpg"), mean("steals").alias("spg"),
        mean("blocks").alias("bpg"), mean("turnovers").alias("topg"),
        share("fg_made", "fg_attempted").alias("fg_pct"), share("fg3_made", "fg3_attempted").alias("fg3_pct"),
        share("ft_made", "ft_attempted").alias("ft_pct"), mean("fg_attempted").alias("fga_pg"),
        mean("fg3_attempted").alias("fg3a_pg"), mean("ft_attempted").alias("fta_pg"),
        n(F.col("is_overtime")).alias("ot_games"), F.min("game_date").alias("first_game"), F.max("game_date").alias("last_game"),
    )


@model("int_team_streaks")
def team_streaks(m: Models) -> DataFrame:
    rows = streak_before(m.tg, ["team_id"], *ORDER, state="is_win")
    rows = rows.select(
        "game_id", "is_home",
        F.when(F.col("streak_state") == 1, F.col("streak_len")).otherwise(0).alias("win_streak"),
        F.when(F.col("streak_state") == 0, F.col("streak_len")).otherwise(0).alias("loss_streak"),
    )
    out = to_game_rows(m.games, rows, {"win_streak": 0, "loss_streak": 0})
    return out.select(
        "game_id", "game_date", "home_team_id", "away_team_id", "home_win_streak", "home_loss_streak",
        "away_win_streak", "away_loss_streak", F.lit(0).alias("home_momentum_score"), F.lit(0).alias("away_momentum_score"),
    )


def rest_exprs(w) -> dict[str, Column]:
    """Days since the previous game, back-to-back and travel marks of a side row."""
    gap = F.datediff("game_date", F.lag("game_date").over(w(None, None)))
    was_home = F.lag("is_home").over(w(None, None))
    b2b = F.coalesce(gap <= 1, F.lit(False))
    # Travel: the venue changed, or both games were away; only home-home is none.
    return {"rest_days": gap, "back_to_back": b2b, "back_to_back_with_travel": b2b & ~(was_home & F.col("is_home"))}


@model("team_rest_rows", table=True)
def team_rest_rows(m: Models) -> DataFrame:
    """Rest marks per side row; written once, seven models read it."""
    return prior_rows(m.tg, ["team_id"], *ORDER, depth=1, exprs=rest_exprs)


@model("int_team_rest_days", table=True)
def team_rest_days(m: Models) -> DataFrame:
    trip = flag(F.col("back_to_back_with_travel"))
    rows = prior_rows(
        m["team_rest_rows"], ["team_id"], *ORDER, depth=9,
        exprs=lambda w: {
            "btb_travel_count_5": F.sum(trip).over(w(-4, 0)),
            "btb_travel_count_10": F.sum(trip).over(w(-9, 0)),
            "travel_fatigue_score_5": F.sum(trip.cast("double")).over(w(-4, 0)),
        },
    )
    out = to_game_rows(
        m.games, rows,
        {"rest_days": 0, "back_to_back": False, "back_to_back_with_travel": False, "btb_travel_count_5": 0,
         "btb_travel_count_10": 0, "travel_fatigue_score_5": 0.0},
        {"rest_advantage": "rest_days"},
    )
    h, a = F.col("home_back_to_back_with_travel"), F.col("away_back_to_back_with_travel")
    out = out.withColumn("back_to_back_travel_advantage", F.when(h & ~a, 1).when(~h & a, -1).otherwise(0))
    for c in ("btb_travel_count_5", "btb_travel_count_10", "travel_fatigue_score_5"):
        out = out.withColumn(f"{c}_diff", F.col(f"home_{c}") - F.col(f"away_{c}"))
    return out


@model("int_team_cum_fatigue")
def team_cumulative_fatigue(m: Models) -> DataFrame:
    rest = m["team_rest_rows"]
    # Games in [day - n, day]: same-day games count, so earlier days plus the own day.
    day = F.lit(1)
    earlier = prior_days(rest, ["team_id"], "game_date", [Measure(f"n{n}", "count", day, n) for n in (7, 10, 14)])
    today = rest.groupBy("team_id", "game_date").agg(F.count(day).alias("n0"))
    rows = prior_rows(
        rest, ["team_id"], *ORDER, depth=4,
        exprs=lambda w: {
            "avg_rest_days_last_7_days": F.avg("rest_days").over(w(-3, 0)),
            "avg_rest_days_last_10_days": F.avg("rest_days").over(w(-4, 0)),
        },
    )
    rows = attach(attach(rows, earlier, ["team_id", "game_date"]), today, ["team_id", "game_date"])
    counts = {n: (F.col(f"n{n}") + F.col("n0")).cast("long") for n in (7, 10, 14)}
    rows = rows.select(
        "game_id", "is_home", *[counts[n].alias(f"games_in_last_{n}_days") for n in counts],
        "avg_rest_days_last_7_days", "avg_rest_days_last_10_days",
        (counts[7] / 7.0).alias("game_density_7_days"), (counts[10] / 10.0).alias("game_density_10_days"),
    )
    cols = {**{f"games_in_last_{n}_days": 0 for n in counts}, "avg_rest_days_last_7_days": 0.0,
            "avg_rest_days_last_10_days": 0.0, "game_density_7_days": 0.0, "game_density_10_days": 0.0}
    return to_game_rows(m.games, rows, cols, {f"{c}_diff": c for c in cols})


# Pair history -------------------------------------------------------------

PAIR = ["lo_id", "hi_id"]


def _from_home(c: str) -> Column:
    """A lower-side signed value seen from the home side of the current game."""
    return F.when(F.col("lo_home"), F.col(c)).otherwise(-F.col(c))


def _home_wins(lo: str, hi: str) -> Column:
    return F.when(F.col("lo_home"), F.col(lo)).otherwise(F.col(hi))


@model("int_team_h2h_stats")
def head_to_head(m: Models) -> DataFrame:
    pairs = with_pair(m.played)

    def last(w, n):
        return {
            f"lo{n}": F.sum("lo_win").over(w(-(n - 1), 0)), f"hi{n}": F.sum("hi_win").over(w(-(n - 1), 0)),
            f"n{n}": F.count(F.lit(1)).over(w(-(n - 1), 0)), f"d{n}": F.avg("lo_margin").over(w(-(n - 1), 0)),
        }

    recent = rows_before_day(pairs, PAIR, *ORDER, depth=5, exprs=lambda w: {**last(w, 3), **last(w, 5), **last(w, 6)})
    totals = prior_days(pairs, PAIR, "game_date", [
        Measure("lo_all", "sum", F.col("lo_win")), Measure("hi_all", "sum", F.col("hi_win")),
        Measure("n_all", "count", F.lit(1)),
    ])
    rows = attach(attach(pairs, recent, [*PAIR, "game_date"]), totals, [*PAIR, "game_date"])
    w3, w5, w6 = (_home_wins(f"lo{n}", f"hi{n}") for n in (3, 5, 6))
    feats = rows.select(
        "game_id",
        _home_wins("lo_all", "hi_all").alias("home_h2h_wins"), _home_wins("hi_all", "lo_all").alias("away_h2h_wins"),
        F.col("n_all").alias("h2h_total_games"),
        ratio(_home_wins("lo_all", "hi_all"), "n_all").alias("home_h2h_win_pct"), w5.alias("home_h2h_recent_wins"),
        ratio(w3, "n3").alias("home_h2h_win_pct_3"), ratio(w5, "n5").alias("home_h2h_win_pct_5"),
        _from_home("d3").alias("home_h2h_avg_point_diff_3"), _from_home("d5").alias("home_h2h_avg_point_diff_5"),
        (2 * w3 - w6).cast("double").alias("home_h2h_momentum"),
    )
    d = {"home_h2h_wins": 0, "away_h2h_wins": 0, "h2h_total_games": 0, "home_h2h_win_pct": 0.5, "home_h2h_recent_wins": 0,
         "home_h2h_win_pct_3": 0.5, "home_h2h_win_pct_5": 0.5, "home_h2h_avg_point_diff_3": 0.0,
         "home_h2h_avg_point_diff_5": 0.0, "home_h2h_momentum": 0.0}
    return _game_defaults(m.games, feats, d)


def _game_defaults(games: DataFrame, feats: DataFrame, defaults: dict) -> DataFrame:
    out = games.select("game_id", "game_date", "home_team_id", "away_team_id").join(feats, "game_id", "left")
    return out.select(
        "game_id", "game_date", "home_team_id", "away_team_id",
        *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()],
    )


@model("int_team_rivalry_ind")
def rivalry(m: Models) -> DataFrame:
    pairs = with_pair(m.played)
    gap = F.abs("lo_margin")
    totals = prior_days(pairs, PAIR, "game_date", [
        Measure("n_all", "count", F.lit(1)), Measure("m_all", "avg", gap),
        Measure("c_all", "avg", flag(gap <= 5)), Measure("v_all", "avg", flag(gap <= 3)),
    ])
    recent = rows_before_day(pairs, PAIR, *ORDER, depth=9, exprs=lambda w: {
        "n10": F.count(F.lit(1)).over(w(-9, 0)), "c5": F.avg(flag(gap <= 5)).over(w(-4, 0)), "m5": F.avg(gap).over(w(-4, 0)),
    })
    rows = attach(attach(pairs, totals, [*PAIR, "game_date"]), recent, [*PAIR, "game_date"])
    feats = rows.select(
        "game_id", F.col("n_all").alias("rivalry_total_matchups"), F.col("n10").alias("rivalry_recent_matchups"),
        F.col("m_all").alias("rivalry_avg_point_margin"), F.col("c_all").alias("rivalry_close_game_pct"),
        F.col("v_all").alias("rivalry_very_close_game_pct"), F.col("c5").alias("rivalry_recent_close_game_pct"),
        F.col("m5").alias("rivalry_recent_avg_margin"),
    )
    return _game_defaults(m.games, feats, {
        "rivalry_total_matchups": 0, "rivalry_recent_matchups": 0, "rivalry_avg_point_margin": 0.0,
        "rivalry_close_game_pct": 0.0, "rivalry_very_close_game_pct": 0.0, "rivalry_recent_close_game_pct": 0.0,
        "rivalry_recent_avg_margin": 0.0,
    })


@model("int_team_opp_specific_perf")
def opponent_specific(m: Models) -> DataFrame:
    pairs = with_pair(m.played)

    def part(w, tag, lo_home):
        at = F.col("lo_home") == F.lit(lo_home)
        f = w(-4, 0)
        return {
            f"n_{tag}": F.count(F.when(at, 1)).over(f), f"d_{tag}": F.avg(F.when(at, F.col("lo_margin"))).over(f),
            f"lo_{tag}": F.avg(F.when(at, F.col("lo_win"))).over(f), f"hi_{tag}": F.avg(F.when(at, F.col("hi_win"))).over(f),
        }

    recent = rows_before_day(pairs, PAIR, *ORDER, depth=4, exprs=lambda w: {**part(w, "l", True), **part(w, "h", False)})
    rows = attach(pairs, recent, [*PAIR, "game_date"])
    lo = F.col("lo_home")

    def pick(a, b):
        return F.when(lo, F.col(a)).otherwise(F.col(b))

    same, swap = ("l", "h"), ("h", "l")  # where the lower side hosted, when it hosts today / when it does not

    def block(side, venue, hosted):
        # `hosted`: meetings at today's home side's place (same) or at the other's (swap).
        n = pick(f"n_{hosted[0]}", f"n_{hosted[1]}")
        d = F.when(lo, F.col(f"d_{hosted[0]}")).otherwise(-F.col(f"d_{hosted[1]}"))
        home_win = pick(f"lo_{hosted[0]}", f"hi_{hosted[1]}")
        base = f"{side}_vs_opponent_{venue}"
        # A tie counts for the away side here: it is "not won by today's home side".
        pct = home_win if side == "home" else 1 - home_win
        return [pct.alias(f"{base}_win_pct"), n.alias(f"{base}_games"), (d if side == "home" else -d).alias(f"{base}_avg_point_diff")]

    feats = rows.select(
        "game_id", *block("home", "home", same), *block("home", "away", swap),
        *block("away", "home", same), *block("away", "away", swap),
    )
    d = {}
    for side in ("home", "away"):
        for venue in ("home", "away"):
            base = f"{side}_vs_opponent_{venue}"
            d |= {f"{base}_win_pct": 0.5, f"{base}_games": 0, f"{base}_avg_point_diff": 0.0}
    out = _game_defaults(m.played, feats, d)
    return out.select(
        "*",
        (F.col("home_vs_opponent_home_win_pct") - F.col("away_vs_opponent_away_win_pct")).alias("opponent_specific_win_pct_diff"),
        (F.col("home_vs_opponent_home_avg_point_diff") - F.col("away_vs_opponent_away_avg_point_diff")).alias(
            "opponent_specific_avg_point_diff_diff"),
    )


# Strength of the opponents ---------------------------------------------------


@model("int_team_opponent_quality")
def opponent_quality(m: Models) -> DataFrame:
    season = m["int_team_season_stats"].select(F.col("team_id").alias("opp_id"), F.col("win_pct").alias("opp_season_pct"))
    ctx = m["team_game_context"].join(season, "opp_id", "left").withColumn("opp_season_pct", nvl("opp_season_pct", 0.5))
    ctx = ctx.withColumn("opp_now", nvl("o_wp10", 0.5))
    rows = prior_rows(ctx, ["team_id"], *ORDER, depth=10, exprs=lambda w: {
        "recent_opp_avg_win_pct": F.avg("opp_season_pct").over(w(-5, -1)),
        "sos_5_rolling": F.avg("opp_now").over(w(-5, -1)),
        "sos_10_rolling": F.avg("opp_now").over(w(-10, -1)),
        "sos_5_weighted": weighted([(F.lag("opp_now", k).over(w(None, None)), 6.0 - k) for k in range(1, 6)]),
    })
    strong = (F.col("opp_season_pct") > 0.6) & F.col("winner_team_id").isNotNull()
    vs = prior_days(ctx, ["team_id"], "game_date", [Measure("performance_vs_quality", "avg", F.when(strong, F.col("is_win")))])
    out = to_game_rows(
        m.games, attach(rows, vs, ["team_id", "game_date"]),
        {c: 0.5 for c in ("recent_opp_avg_win_pct", "performance_vs_quality", "sos_5_rolling", "sos_10_rolling", "sos_5_weighted")},
    )
    return out


@model("int_away_upset_tend")
def away_upset_tendency(m: Models) -> DataFrame:
    pct = m["int_team_season_stats"].select("team_id", "win_pct")
    ctx = m["team_game_context"].filter(~F.col("is_home"))
    ctx = ctx.join(pct.withColumnRenamed("win_pct", "mine"), "team_id", "left").join(
        pct.select(F.col("team_id").alias("opp_id"), F.col("win_pct").alias("theirs")), "opp_id", "left"
    )
    season = nvl("mine", 0.5) < nvl("theirs", 0.5)
    rolling = nvl("now10", 0.5) < nvl("o_now10", 0.5)
    win = F.col("is_win") == 1
    rows = running(ctx, ["team_id"], *ORDER, sums={
        "gs": flag(season), "ws": flag(season & win), "gr": flag(rolling), "wr": flag(rolling & win),
    })

    def rate(w, g):
        return F.when(F.col(g) >= 5, ratio(w, g)).otherwise(0.3)

    return rows.select(
        "game_id", "game_date", F.col("team_id").alias("away_team_id"),
        rate("ws", "gs").alias("away_upset_tendency_season"), rate("wr", "gr").alias("away_upset_tendency_rolling"),
        F.least(F.col("gs"), F.lit(50)).cast("int").alias("away_upset_sample_size_season"),
        F.least(F.col("gr"), F.lit(50)).cast("int").alias("away_upset_sample_size_rolling"),
    )


# Momentum and streak quality --------------------------------------------------


@model("int_team_recent_mom_exp")
def exponential_momentum(m: Models) -> DataFrame:
    box = box_rows(m).withColumn("diff", (F.col("points") - F.col("opponent_points")).cast("double"))
    rows = prior_rows(box, ["team_id"], *ORDER, depth=10, exprs=lambda w: {
        **{f"exp_weighted_{name}_10": decayed(w, F.col(c).cast("double"), 10, 0.2)
           for name, c in (("win_pct", "is_win"), ("point_diff", "diff"), ("ppg", "points"), ("opp_ppg", "opponent_points"))},
        **{f"exp_weighted_{name}_5": decayed(w, F.col(c).cast("double"), 5, 0.2)
           for name, c in (("win_pct", "is_win"), ("point_diff", "diff"))},
    })
    d = {f"exp_weighted_{n}_10": v for n, v in (("win_pct", 0.5), ("point_diff", 0.0), ("ppg", 0.0), ("opp_ppg", 0.0))}
    d |= {"exp_weighted_win_pct_5": 0.5, "exp_weighted_point_diff_5": 0.0}
    diffs = {c[:-3] + "_diff_10" if c.endswith("_10") else c[:-2] + "_diff_5": c for c in d}
    return to_game_rows(m.played, rows, d, diffs, keep=("game_id", "game_date"))


@model("int_team_weighted_momentum")
def weighted_momentum(m: Models) -> DataFrame:
    s = nvl("o_wp10", 0.5)
    ctx = m["team_game_context"].filter("winner_team_id is not null").withColumn(
        "gain", F.when(F.col("is_win") == 1, s).otherwise(s - 1)
    )
    rows = prior_rows(ctx, ["team_id"], *ORDER, depth=10, exprs=lambda w: {
        "weighted_momentum_5": F.sum("gain").over(w(-5, -1)), "weighted_momentum_10": F.sum("gain").over(w(-10, -1)),
    })
    return to_game_rows(
        m.games, rows, {"weighted_momentum_5": 0.0, "weighted_momentum_10": 0.0},
        {"weighted_momentum_diff_5": "weighted_momentum_5", "weighted_momentum_diff_10": "weighted_momentum_10"},
    )


@model("int_team_streak_qual")
def win_streak_quality(m: Models) -> DataFrame:
    rows = streak_before(m["team_game_context"], ["team_id"], *ORDER, state="is_win", measures={"q": nvl("o_wp10", 0.5)})
    on = F.col("streak_state") == 1
    # Length times average quality is the sum of the qualities.
    rows = rows.select("game_id", "is_home", F.when(on, F.col("streak_q")).otherwise(0.0).alias("win_streak_quality"),
                       F.when(on, F.col("streak_len")).otherwise(0).alias("len"))
    out = to_game_rows(m.games, rows, {"win_streak_quality": 0.0, "len": 0},
                       {"win_streak_quality_diff": "win_streak_quality", "win_streak_length_diff": "len"},
                       keep=("game_id", "game_date"))
    return out.drop("home_len", "away_len")


@model("int_team_ctx_streaks")
def contextualized_streaks(m: Models) -> DataFrame:
    q = nvl("o_wp10", 0.5)
    # A win away counts 0.9, a loss away 1.1, any home game 1.0.
    mult = F.when(F.col("is_home"), 1.0).when(F.col("is_win") == 1, 0.9).otherwise(1.1)
    rows = streak_before(m["team_game_context"], ["team_id"], *ORDER, state="is_win", measures={"q": q, "v": q * mult})

    def when(state, value):
        return F.when(F.col("streak_state").isNotNull(), F.when(F.col("streak_state") == state, value).otherwise(0.0))

    mean = ratio("streak_q", "streak_len")
    rows = rows.select(
        "game_id", "is_home", when(1, F.col("streak_v")).alias("weighted_win_streak"), when(0, F.col("streak_v")).alias("weighted_loss_streak"),
        when(1, mean).alias("win_streak_avg_opponent_quality"), when(0, mean).alias("loss_streak_avg_opponent_quality"),
    )
    return to_game_rows(m.played, rows, {
        "weighted_win_streak": 0.0, "weighted_loss_streak": 0.0,
        "win_streak_avg_opponent_quality": 0.5, "loss_streak_avg_opponent_quality": 0.5,
    })
