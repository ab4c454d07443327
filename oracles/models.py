"""Check queries of the feature models."""

from __future__ import annotations

from .sql import CTES, IDS, cte, defaults, game, h, hist, last_n, over, r, sides, split

SQL: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    """A model's check is also a CTE, so later models can build on it."""
    SQL[name] = sql
    cte(name, sql)


cte("games", """select *, case when home_score > away_score then home_team_id when away_score > home_score then away_team_id end as winner_team_id,
 game_status like '%OT%' as is_overtime, home_score is not null and away_score is not null as is_completed from v_games""")
cte("played", "select * from games where is_completed")
cte("finished", "select * from played where winner_team_id is not null")
cte("tg", """select game_id, game_date, season, winner_team_id, is_overtime, home_team_id as team_id, away_team_id as opp_id, true as is_home,
  home_score as pts, away_score as opp_pts, case when winner_team_id = home_team_id then 1 else 0 end as is_win, home_score - away_score as margin, year(game_date) as yr from played
 union all select game_id, game_date, season, winner_team_id, is_overtime, away_team_id, home_team_id, false, away_score, home_score,
  case when winner_team_id = away_team_id then 1 else 0 end, away_score - home_score, year(game_date) from played""")
cte("tgd", "select * from tg where winner_team_id is not null")
cte("box", """select t.game_id, t.game_date, t.season, t.yr, t.team_id, t.opp_id, t.is_home, t.winner_team_id, t.is_overtime, t.is_win, t.opp_pts as opponent_points,
 b.* exclude (game_id, team_id, game_date, is_home), (b.fg_made + 0.5 * b.fg3_made) / b.fg_attempted as efg_pct,
 b.points / (2.0 * (b.fg_attempted + 0.44 * b.ft_attempted)) as ts_pct, cast(b.fg_attempted + 0.44 * b.ft_attempted + b.turnovers as double) as possessions
 from tg t join v_team_boxscores b on b.game_id = t.game_id and b.team_id = t.team_id""")

DIGITS = {"ppg": 1, "opp_ppg": 1, "win_pct": 3, "apg": 1, "rpg": 1, "fg_pct": 3, "fg3_pct": 3, "efg_pct": 3, "ts_pct": 3,
          "possessions": 1, "off_rtg": 1, "def_rtg": 1, "net_rtg": 1, "pace": 1, "tov_rate": 2, "assist_rate": 2,
          "steal_rate": 2, "block_rate": 2, "ppg_stddev": 1, "opp_ppg_stddev": 1, "ppg_cv": 3, "opp_ppg_cv": 3}


def _rolling(n: int) -> str:
    w = over(-n, -1)

    def a(c):
        return f"avg({c}) {w}"

    e = {"ppg": a("points"), "opp_ppg": a("opponent_points"), "win_pct": a("is_win"), "apg": a("assists"), "rpg": a("rebounds"),
         "fg_pct": a("fg_pct"), "fg3_pct": a("fg3_pct"), "efg_pct": a("efg_pct"), "ts_pct": a("ts_pct"), "possessions": a("possessions"),
         "off_rtg": f"100.0 * {a('points')} / {a('possessions')}", "def_rtg": f"100.0 * {a('opponent_points')} / {a('possessions')}",
         "net_rtg": f"100.0 * ({a('points')} - {a('opponent_points')}) / {a('possessions')}", "pace": a("possessions"),
         "tov_rate": f"100.0 * {a('turnovers')} / {a('possessions')}", "assist_rate": f"100.0 * {a('assists')} / {a('possessions')}",
         "steal_rate": f"100.0 * {a('steals')} / {a('possessions')}", "block_rate": f"100.0 * {a('blocks')} / {a('possessions')}",
         "ppg_stddev": f"stddev_samp(points) {w}", "opp_ppg_stddev": f"stddev_samp(opponent_points) {w}",
         "ppg_cv": f"stddev_samp(points) {w} / {a('points')}", "opp_ppg_cv": f"stddev_samp(opponent_points) {w} / {a('opponent_points')}"}
    cols = [f"{h(e[k], d)} as rolling_{n}_{k}" for k, d in DIGITS.items()]
    cols += [f"cast(sum(is_win) {w} as bigint) as wins_last_{n}", f"count(*) {w} as games_in_{n}_window"]
    return ", ".join(cols)


add("int_team_rolling_stats", f"""select * from (select team_id, game_date, game_id, row_number() over (partition by team_id order by game_date, game_id) as game_num,
 is_home, points, opponent_points, case when winner_team_id is not null then is_win = 1 end as is_win, {_rolling(5)}, {_rolling(10)}
 from (select *, is_win as w from box)) where game_num > 5""")

_TEN = [k for k in DIGITS if k not in ("apg", "rpg", "fg_pct", "fg3_pct")]
LOOKUP = [f"rolling_5_{k}" for k in DIGITS] + ["wins_last_5"] + [f"rolling_10_{k}" for k in _TEN] + ["wins_last_10"]
cte("roll_day", "select * from int_team_rolling_stats qualify row_number() over (partition by team_id, game_date order by game_id desc) = 1")
add("int_team_roll_lkp", f"""select t.game_id, t.game_date, t.team_id, {', '.join('q.' + c for c in LOOKUP)}
 from tg t asof left join roll_day q on q.team_id = t.team_id and q.game_date < t.game_date""")

_CTX = {"rolling_5_win_pct": "wp5", "rolling_10_win_pct": "wp10", "rolling_5_net_rtg": "nr5", "rolling_10_net_rtg": "nr10",
        "rolling_10_pace": "pace10", "rolling_10_off_rtg": "off10", "rolling_10_def_rtg": "def10"}
cte("ctx", f"""select t.*, {', '.join(f'l.{c} as {a}' for c, a in _CTX.items())}, {', '.join(f'o.{c} as o_{a}' for c, a in _CTX.items())},
 n.rolling_10_win_pct as now10, m.rolling_10_win_pct as o_now10 from tg t
 left join int_team_roll_lkp l on l.game_id = t.game_id and l.team_id = t.team_id left join int_team_roll_lkp o on o.game_id = t.game_id and o.team_id = t.opp_id
 left join int_team_rolling_stats n on n.game_id = t.game_id and n.team_id = t.team_id left join int_team_rolling_stats m on m.game_id = t.game_id and m.team_id = t.opp_id""")
cte("ctxd", "select * from ctx where winner_team_id is not null")


def _n(c):
    return f"cast(sum(case when {c} then 1 else 0 end) as bigint)"


_LOST = "winner_team_id is not null and is_win = 0"
add("int_team_season_stats", f"""select team_id, count(*) as games_played, {_n('is_win = 1')} as wins, {_n(_LOST)} as losses, {h('sum(is_win) / count(*)', 3)} as win_pct,
 {_n('is_home and is_win = 1')} as home_wins, {_n('is_home and ' + _LOST)} as home_losses, {_n('not is_home and is_win = 1')} as away_wins, {_n('not is_home and ' + _LOST)} as away_losses,
 {h('avg(points)', 1)} as ppg, {h('avg(opponent_points)', 1)} as opp_ppg, {h('avg(points) - avg(opponent_points)', 1)} as point_diff,
 {h('avg(assists)', 1)} as apg, {h('avg(rebounds)', 1)} as rpg, {h('avg(steals)', 1)} as spg, {h('avg(blocks)', 1)} as bpg, {h('avg(turnovers)', 1)} as topg,
 {h('sum(fg_made) / sum(fg_attempted)', 3)} as fg_pct, {h('sum(fg3_made) / sum(fg3_attempted)', 3)} as fg3_pct, {h('sum(ft_made) / sum(ft_attempted)', 3)} as ft_pct,
 {h('avg(fg_attempted)', 1)} as fga_pg, {h('avg(fg3_attempted)', 1)} as fg3a_pg, {h('avg(ft_attempted)', 1)} as fta_pg, {_n('is_overtime')} as ot_games,
 min(game_date) as first_game, max(game_date) as last_game from box group by team_id""")

# Streaks by gaps and islands: the difference of two row numbers names the run.
cte("runs", """select *, row_number() over (partition by team_id order by game_date, game_id) - row_number() over (partition by team_id, is_win order by game_date, game_id) as run from ctx""")
cte("run_rows", """select game_id, team_id, is_home, is_win, game_date, count(*) over q as len, sum(coalesce(o_wp10, 0.5)) over q as qual,
 sum(coalesce(o_wp10, 0.5) * case when is_home then 1.0 when is_win = 1 then 0.9 else 1.1 end) over q as wv
 from runs window q as (partition by team_id, is_win, run order by game_date, game_id)""")
cte("prev_run", """select game_id, is_home, lag(is_win) over q as st, lag(len) over q as len, lag(qual) over q as qual, lag(wv) over q as wv
 from run_rows window q as (partition by team_id order by game_date, game_id)""")
cte("f_streak", "select game_id, is_home, case when st = 1 then len else 0 end as win_streak, case when st = 0 then len else 0 end as loss_streak from prev_run")
add("int_team_streaks", sides("f_streak", {"win_streak": 0, "loss_streak": 0}, extra=", 0 as home_momentum_score, 0 as away_momentum_score"))

cte("rest1", """select *, game_date - lag(game_date) over q as rest_days, lag(is_home) over q as was_home from tg window q as (partition by team_id order by game_date, game_id)""")
cte("rest2", """select *, coalesce(rest_days <= 1, false) as back_to_back, coalesce(rest_days <= 1, false) and (was_home <> is_home or (not was_home and not is_home)) as back_to_back_with_travel from rest1""")
cte("rest3", f"""select *, sum(back_to_back_with_travel::int) {over(-4, 0)} as btb_travel_count_5, sum(back_to_back_with_travel::int) {over(-9, 0)} as btb_travel_count_10,
 cast(sum(back_to_back_with_travel::int) {over(-4, 0)} as double) as travel_fatigue_score_5 from rest2""")
add("int_team_rest_days", "select * exclude (h_t, a_t), case when h_t and not a_t then 1 when a_t and not h_t then -1 else 0 end as back_to_back_travel_advantage from (" + sides(
    "rest3", {"rest_days": 0, "back_to_back": False, "back_to_back_with_travel": False, "btb_travel_count_5": 0, "btb_travel_count_10": 0, "travel_fatigue_score_5": 0.0},
    {"rest_advantage": "rest_days", "btb_travel_count_5_diff": "btb_travel_count_5", "btb_travel_count_10_diff": "btb_travel_count_10", "travel_fatigue_score_5_diff": "travel_fatigue_score_5"},
    extra=", coalesce(h.back_to_back_with_travel, false) as h_t, coalesce(a.back_to_back_with_travel, false) as a_t") + ")")


def _range(n):
    return f"count(*) over (partition by team_id order by game_date range between interval {n} days preceding and current row)"


cte("fatigue", f"""select game_id, is_home, {', '.join(f'{_range(n)} as games_in_last_{n}_days' for n in (7, 10, 14))}, avg(rest_days) {over(-3, 0)} as avg_rest_days_last_7_days,
 avg(rest_days) {over(-4, 0)} as avg_rest_days_last_10_days, {_range(7)} / 7.0 as game_density_7_days, {_range(10)} / 10.0 as game_density_10_days from rest2""")
_F = {**{f"games_in_last_{n}_days": 0 for n in (7, 10, 14)}, "avg_rest_days_last_7_days": 0.0, "avg_rest_days_last_10_days": 0.0, "game_density_7_days": 0.0, "game_density_10_days": 0.0}
add("int_team_cum_fatigue", sides("fatigue", _F, {f"{c}_diff": c for c in _F}))

# Pairs: the naive OR self-join.
cte("meet", """select c.game_id, c.home_team_id, p.game_id as pid, p.game_date as pdate, abs(p.home_score - p.away_score) as gap,
 p.home_team_id = c.home_team_id as same_venue, case when p.winner_team_id = c.home_team_id then 1 else 0 end as hw, case when p.winner_team_id = c.away_team_id then 1 else 0 end as aw,
 case when p.home_team_id = c.home_team_id then p.home_score - p.away_score else p.away_score - p.home_score end as hd,
 row_number() over (partition by c.game_id order by p.game_date desc, p.game_id desc) as k
 from played c join played p on least(p.home_team_id, p.away_team_id) = least(c.home_team_id, c.away_team_id) and greatest(p.home_team_id, p.away_team_id) = greatest(c.home_team_id, c.away_team_id) and p.game_date < c.game_date""")
cte("f_h2h", """select game_id, cast(sum(hw) as bigint) as home_h2h_wins, cast(sum(aw) as bigint) as away_h2h_wins, count(*) as h2h_total_games, avg(hw) as home_h2h_win_pct,
 cast(sum(case when k <= 5 then hw end) as bigint) as home_h2h_recent_wins, avg(case when k <= 3 then hw end) as home_h2h_win_pct_3, avg(case when k <= 5 then hw end) as home_h2h_win_pct_5,
 avg(case when k <= 3 then hd end) as home_h2h_avg_point_diff_3, avg(case when k <= 5 then hd end) as home_h2h_avg_point_diff_5,
 cast(sum(case when k <= 3 then hw when k <= 6 then -hw end) as double) as home_h2h_momentum from meet group by 1""")
add("int_team_h2h_stats", game("f_h2h", {
    "home_h2h_wins": 0, "away_h2h_wins": 0, "h2h_total_games": 0, "home_h2h_win_pct": 0.5, "home_h2h_recent_wins": 0, "home_h2h_win_pct_3": 0.5,
    "home_h2h_win_pct_5": 0.5, "home_h2h_avg_point_diff_3": 0.0, "home_h2h_avg_point_diff_5": 0.0, "home_h2h_momentum": 0.0}))
cte("f_riv", """select game_id, count(*) as rivalry_total_matchups, count(case when k <= 10 then 1 end) as rivalry_recent_matchups, avg(gap) as rivalry_avg_point_margin,
 avg((gap <= 5)::int) as rivalry_close_game_pct, avg((gap <= 3)::int) as rivalry_very_close_game_pct, avg(case when k <= 5 then (gap <= 5)::int end) as rivalry_recent_close_game_pct,
 avg(case when k <= 5 then gap end) as rivalry_recent_avg_margin from meet group by 1""")
add("int_team_rivalry_ind", game("f_riv", {"rivalry_total_matchups": 0, "rivalry_recent_matchups": 0, "rivalry_avg_point_margin": 0.0, "rivalry_close_game_pct": 0.0,
                                           "rivalry_very_close_game_pct": 0.0, "rivalry_recent_close_game_pct": 0.0, "rivalry_recent_avg_margin": 0.0}))
_sv = {"home": "same_venue", "away": "not same_venue"}
cte("f_spec", "select game_id, " + ", ".join(
    f"avg(case when {c} then {'hw' if s == 'home' else '1 - hw'} end) as {s}_vs_opponent_{v}_win_pct, count(case when {c} then 1 end) as {s}_vs_opponent_{v}_games, "
    f"avg(case when {c} then {'hd' if s == 'home' else '-hd'} end) as {s}_vs_opponent_{v}_avg_point_diff" for s in ("home", "away") for v, c in _sv.items()) + " from meet where k <= 5 group by 1")
_d = {}
for _s in ("home", "away"):
    for _v in ("home", "away"):
        _d |= {f"{_s}_vs_opponent_{_v}_win_pct": 0.5, f"{_s}_vs_opponent_{_v}_games": 0, f"{_s}_vs_opponent_{_v}_avg_point_diff": 0.0}
add("int_team_opp_specific_perf", game("f_spec", _d, "played").replace(" from played g", f""",
 {r('coalesce(f.home_vs_opponent_home_win_pct, 0.5) - coalesce(f.away_vs_opponent_away_win_pct, 0.5)')} as opponent_specific_win_pct_diff,
 {r('coalesce(f.home_vs_opponent_home_avg_point_diff, 0.0) - coalesce(f.away_vs_opponent_away_avg_point_diff, 0.0)')} as opponent_specific_avg_point_diff_diff from played g"""))

cte("oq_rows", """select c.*, coalesce(s.win_pct, 0.5) as osp, coalesce(c.o_wp10, 0.5) as onow, row_number() over (partition by c.team_id order by c.game_date, c.game_id) as i
 from ctx c left join int_team_season_stats s on s.team_id = c.opp_id""")
cte("oq1", """select a.game_id, a.is_home, avg(case when a.i - p.i <= 5 then p.osp end) as recent_opp_avg_win_pct, avg(case when a.i - p.i <= 5 then p.onow end) as sos_5_rolling, avg(p.onow) as sos_10_rolling,
 sum(case when a.i - p.i <= 5 then p.onow * (6 - (a.i - p.i)) end) / sum(case when a.i - p.i <= 5 then 6 - (a.i - p.i) end) as sos_5_weighted
 from oq_rows a left join oq_rows p on p.team_id = a.team_id and p.i < a.i and p.i >= a.i - 10 group by 1, 2""")
cte("oq2", hist("oq_rows", {"performance_vs_quality": "avg(case when p.osp > 0.6 and p.winner_team_id is not null then p.is_win end)"}, ["team_id"]))
cte("f_oq", "select oq1.*, performance_vs_quality from oq1 join oq2 using (game_id, is_home)")
add("int_team_opponent_quality", sides("f_oq", {c: 0.5 for c in ("recent_opp_avg_win_pct", "performance_vs_quality", "sos_5_rolling", "sos_10_rolling", "sos_5_weighted")}))

cte("ups", """select c.game_id, c.game_date, c.team_id, c.is_win, coalesce(s.win_pct, 0.5) < coalesce(o.win_pct, 0.5) as ds, coalesce(c.now10, 0.5) < coalesce(c.o_now10, 0.5) as dr
 from ctx c left join int_team_season_stats s on s.team_id = c.team_id left join int_team_season_stats o on o.team_id = c.opp_id where not c.is_home""")
_U = "over (partition by team_id order by game_date, game_id rows between unbounded preceding and 1 preceding)"
cte("ups2", f"""select *, coalesce(sum(ds::int) {_U}, 0) as gs, coalesce(sum((ds and is_win = 1)::int) {_U}, 0) as ws, coalesce(sum(dr::int) {_U}, 0) as gr, coalesce(sum((dr and is_win = 1)::int) {_U}, 0) as wr from ups""")
add("int_away_upset_tend", f"""select game_id, game_date, team_id as away_team_id, {r('case when gs >= 5 then ws / gs else 0.3 end')} as away_upset_tendency_season, {r('case when gr >= 5 then wr / gr else 0.3 end')} as away_upset_tendency_rolling,
 cast(least(gs, 50) as int) as away_upset_sample_size_season, cast(least(gr, 50) as int) as away_upset_sample_size_rolling from ups2""")

cte("box_i", "select *, points - opponent_points as diff, row_number() over (partition by team_id order by game_date, game_id) as i from box")


def _exp(c, n):
    return f"sum(case when a.i - p.i <= {n} then p.{c} * exp(-0.2 * (a.i - p.i - 1)) end) / sum(case when a.i - p.i <= {n} then exp(-0.2 * (a.i - p.i - 1)) end)"


_E = {"exp_weighted_win_pct_10": ("is_win", 10, 0.5), "exp_weighted_point_diff_10": ("diff", 10, 0.0), "exp_weighted_ppg_10": ("points", 10, 0.0),
      "exp_weighted_opp_ppg_10": ("opponent_points", 10, 0.0), "exp_weighted_win_pct_5": ("is_win", 5, 0.5), "exp_weighted_point_diff_5": ("diff", 5, 0.0)}
cte("f_exp", f"select a.game_id, a.is_home, {', '.join(f'{_exp(c, n)} as {k}' for k, (c, n, _) in _E.items())} from box_i a left join box_i p on p.team_id = a.team_id and p.i < a.i and p.i >= a.i - 10 group by 1, 2")
add("int_team_recent_mom_exp", sides("f_exp", {k: d for k, (_, _, d) in _E.items()}, {k.rsplit("_", 1)[0] + "_diff_" + k.rsplit("_", 1)[1]: k for k in _E}, base="played", ids="g.game_id, g.game_date"))

cte("wmom", f"""select game_id, is_home, sum(gain) {over(-5, -1)} as weighted_momentum_5, sum(gain) {over(-10, -1)} as weighted_momentum_10
 from (select *, case when is_win = 1 then coalesce(o_wp10, 0.5) else coalesce(o_wp10, 0.5) - 1 end as gain from ctxd)""")
add("int_team_weighted_momentum", sides("wmom", {"weighted_momentum_5": 0.0, "weighted_momentum_10": 0.0}, {"weighted_momentum_diff_5": "weighted_momentum_5", "weighted_momentum_diff_10": "weighted_momentum_10"}))
cte("f_sq", "select game_id, is_home, case when st = 1 then len * (qual / len) else 0.0 end as win_streak_quality, case when st = 1 then len else 0 end as len from prev_run")
add("int_team_streak_qual", "select * exclude (home_len, away_len) from (" + sides("f_sq", {"win_streak_quality": 0.0, "len": 0}, {"win_streak_quality_diff": "win_streak_quality", "win_streak_length_diff": "len"}, ids="g.game_id, g.game_date") + ")")
cte("f_cs", """select game_id, is_home, case when st = 1 then wv when st = 0 then 0.0 end as weighted_win_streak, case when st = 0 then wv when st = 1 then 0.0 end as weighted_loss_streak,
 case when st = 1 then qual / len when st = 0 then 0.0 end as win_streak_avg_opponent_quality, case when st = 0 then qual / len when st = 1 then 0.0 end as loss_streak_avg_opponent_quality from prev_run""")
add("int_team_ctx_streaks", sides("f_cs", {"weighted_win_streak": 0.0, "weighted_loss_streak": 0.0, "win_streak_avg_opponent_quality": 0.5, "loss_streak_avg_opponent_quality": 0.5}, base="played"))

# Context splits.
cte("tiered", "select *, case when o_now10 >= 0.6 then 'top' when o_now10 >= 0.4 then 'middle' else 'bottom' end as tier from ctx where o_now10 is not null")
_T = {"win_pct_vs_opponent_tier": 0.5, "avg_point_diff_vs_opponent_tier": 0.0, "game_count_vs_opponent_tier": 0}
cte("f_tier", hist("tiered", {"win_pct_vs_opponent_tier": "avg(p.is_win)", "avg_point_diff_vs_opponent_tier": "avg(p.margin)", "game_count_vs_opponent_tier": "count(p.game_id)"}, ["team_id", "is_home", "tier"], 90))
add("int_team_opp_tier_perf", sides("f_tier", _T, {f"{c}_diff": c for c in list(_T)[:2]}))
_A, _TD = {}, {}
for _p, _c in (("at_home", "p.is_home"), ("on_road", "not p.is_home")):
    _A |= split("", _c, tuple(f"{x}_vs_opponent_tier_{_p}" for x in ("win_pct", "game_count", "avg_point_diff")))
    _TD |= {f"win_pct_vs_opponent_tier_{_p}": 0.5, f"avg_point_diff_vs_opponent_tier_{_p}": 0.0, f"game_count_vs_opponent_tier_{_p}": 0}
cte("f_tier_ha", hist("tiered", _A, ["team_id", "tier"], 90))
add("int_team_opp_tier_ha", sides("f_tier_ha", _TD, extra="".join(
    f", {r(f'coalesce(h.{c}_vs_opponent_tier_at_home, {d}) - coalesce(a.{c}_vs_opponent_tier_on_road, {d})')} as {c}_vs_opponent_tier_home_away_diff" for c, d in (("win_pct", 0.5), ("avg_point_diff", 0.0)))))

cte("rested", """select c.*, coalesce(m.rest_days, 0) as rest_days, m.back_to_back, m.back_to_back_with_travel, coalesce(o.rest_days, 0) as o_rest_days, o.back_to_back as o_back_to_back, o.back_to_back_with_travel as o_back_to_back_with_travel
 from ctx c join rest2 m on m.game_id = c.game_id and m.team_id = c.team_id join rest2 o on o.game_id = c.game_id and o.team_id = c.opp_id""")
cte("rested_b", """select *, case when rest_days <= 1 then 'back_to_back' when rest_days = 2 then '2_days' else 'well_rested' end as rest_bucket,
 concat(case when is_home then least(greatest(rest_days, 1), 3) else least(greatest(o_rest_days, 1), 3) end, '_', case when is_home then least(greatest(o_rest_days, 1), 3) else least(greatest(rest_days, 1), 3) end) as combo from rested""")
_st = {"strong": "p.o_wp10 > 0.5", "weak": "p.game_id is not null and (p.o_wp10 is null or p.o_wp10 <= 0.5)"}
_a, _dd = {}, {"rest_bucket": None}
for _k, _c in _st.items():
    _a |= {f"win_pct_vs_{_k}_by_rest": f"avg(case when {_c} then p.is_win end)", f"games_vs_{_k}_by_rest": f"count(case when {_c} then 1 end)"}
    _dd |= {f"win_pct_vs_{_k}_by_rest": 0.5, f"games_vs_{_k}_by_rest": 0}
cte("f_qr", hist("rested_b", {"rest_bucket": "any_value(a.rest_bucket)", **_a}, ["team_id", "is_home", "yr", "rest_bucket"]))
add("int_team_perf_vs_opp_qual_rest", sides("f_qr", _dd, base="played"))


def _dec(x, d):
    return f"cast(coalesce({x}, {d}) as decimal(9,3))"


def similar(name, src, flag, n, diff, cols, current, score="near", cur_default=0):
    cte(f"sim_{name}", f"select *, {diff} as pd, {flag} as near from ({src})")
    cte(f"simo_{name}", f"select game_id, is_home, avg(is_win) {over(-n, -1)} as {cols[0]}, avg(pd) {over(-n, -1)} as {cols[1]}, cast(count(*) {over(-n, -1)} as int) as {cols[2]} from sim_{name} where near")
    sc = f"coalesce(c.{score}{'::int' if score == 'near' else ''}, {cur_default})"
    sql = sides(f"simo_{name}", {cols[0]: 0.5, cols[1]: 0.0, cols[2]: 0}, base="played", extra=f", {r(sc) if score != 'near' else sc} as {current}")
    return sql + f" left join sim_{name} c on c.game_id = g.game_id and c.is_home"


add("int_team_perf_vs_similar_qual", similar("q", "select * from ctxd", f"abs({_dec('wp10', 0.5)} - {_dec('o_wp10', 0.5)}) <= 0.1 or abs({_dec('nr10', 0)} - {_dec('o_nr10', 0)}) <= 3", 10, "margin",
    ("win_pct_vs_similar_quality", "avg_point_diff_vs_similar_quality", "similar_quality_game_count"), "is_current_game_similar_quality"))
add("int_team_perf_vs_similar_mom", similar("m", "select * from ctxd", f"abs({_dec('wp5', 0.5)} - {_dec('o_wp5', 0.5)}) <= 0.15 or abs({_dec('nr5', 0)} - {_dec('o_nr5', 0)}) <= 4", 10, "margin",
    ("win_pct_vs_similar_momentum", "avg_point_diff_vs_similar_momentum", "similar_momentum_game_count"), "is_current_game_similar_momentum"))
_g = " + ".join(f"pow((coalesce({c}, {v}) - coalesce(o_{c}, {v})) / 20.0, 2)" for c, v in (("pace10", "95.0"), ("off10", "110.0"), ("def10", "110.0")))
add("int_team_opp_similarity_perf", similar("s", f"select *, 1.0 / (1.0 + sqrt({_g})) as score from ctxd", "score > 0.7", 15, "case when is_win = 1 then 5.0 else -5.0 end",
    ("win_pct_vs_similar_opponents", "avg_point_diff_vs_similar_opponents", "similar_opponent_game_count"), "current_game_similarity_score", "score", 0.5))

cte("strong_rows", "select * from ctx where o_now10 is not null")
_QD = {}
for _k, _days in ((5, 30), (10, 60)):
    cte(f"f_qa{_k}", last_n("ctx", "strong_rows", _k, {
        f"avg_opponent_strength_in_wins_{_k}": "avg(case when is_win = 1 then o_now10 end)", f"avg_opponent_strength_in_losses_{_k}": "avg(case when is_win = 0 then o_now10 end)",
        f"avg_opponent_strength_{_k}": "avg(o_now10)", f"quality_adjusted_win_pct_{_k}": "case when sum(o_now10) > 0 then sum(case when is_win = 1 then o_now10 else 0.0 end) / sum(o_now10) end",
        f"avg_point_diff_in_wins_{_k}": "avg(case when is_win = 1 then margin end)", f"avg_point_diff_in_losses_{_k}": "avg(case when is_win = 0 then margin end)",
        f"wins_count_{_k}": "count(case when is_win = 1 then 1 end)", f"losses_count_{_k}": "count(case when is_win = 0 then 1 end)", f"total_games_{_k}": "count(*)"}, ["team_id"], f"p.game_date >= a.game_date - {_days}"))
    _QD |= {f"avg_opponent_strength_in_wins_{_k}": 0.5, f"avg_opponent_strength_in_losses_{_k}": 0.5, f"avg_opponent_strength_{_k}": 0.5, f"quality_adjusted_win_pct_{_k}": 0.5,
            f"avg_point_diff_in_wins_{_k}": 0.0, f"avg_point_diff_in_losses_{_k}": 0.0, f"wins_count_{_k}": 0, f"losses_count_{_k}": 0, f"total_games_{_k}": 0}
cte("f_qa", "select * from f_qa10 left join f_qa5 using (game_id, is_home)")
add("int_team_quality_adj_perf", sides("f_qa", _QD, {f"{c}_diff_{k}": f"{c}_{k}" for c in ("quality_adjusted_win_pct", "avg_opponent_strength") for k in (5, 10)}))

_W = {}
for _k in (5, 10):
    _w = over(-_k, -1)
    _W |= {f"weighted_win_pct_{_k}": f"sum(is_win * s) {_w} / nullif(sum(s) {_w}, 0)", f"weighted_point_diff_{_k}": f"sum(margin * s) {_w} / nullif(sum(s) {_w}, 0)",
           f"weighted_net_rtg_{_k}": f"sum(margin / 100.0 * nr) {_w} / nullif(sum(nr) {_w}, 0) * 100.0"}
cte("f_wq", f"select game_id, is_home, {', '.join(f'{e} as {k}' for k, e in _W.items())} from (select *, coalesce(o_wp10, 0.5) as s, abs(coalesce(o_nr10, 0.0)) as nr from ctxd)")
add("int_team_recent_perf_wt_opp_qual", sides("f_wq", {k: 0.5 if "win_pct" in k else 0.0 for k in _W}, {k.rsplit("_", 1)[0] + "_diff_" + k.rsplit("_", 1)[1]: k for k in _W}, base="played"))

cte("f_hr", hist("tg", {"pct": "avg(p.is_win)"}, ["team_id", "is_home", "yr"]))
add("int_team_home_road_perf", f"select {IDS}, {r('coalesce(h.pct, 0.5)')} as home_home_win_pct, {r('coalesce(a.pct, 0.5)')} as away_road_win_pct, {r('coalesce(h.pct, 0.5) - coalesce(a.pct, 0.5)')} as home_advantage"
    " from games g left join f_hr h on h.game_id = g.game_id and h.is_home left join f_hr a on a.game_id = g.game_id and not a.is_home")
cte("f_haq", hist("ctx", {"win_pct_vs_strong": f"avg(case when {_st['strong']} then p.is_win end)", "win_pct_vs_weak": f"avg(case when {_st['weak']} then p.is_win end)"}, ["team_id", "is_home", "yr"]))
add("int_team_home_away_opp_qual", sides("f_haq", {"win_pct_vs_strong": 0.5, "win_pct_vs_weak": 0.5}))
cte("f_har", hist("rested_b", {"win_pct_by_rest_bucket": "avg(p.is_win)"}, ["team_id", "is_home", "yr", "rest_bucket"]))
add("int_team_home_away_rest_perf", sides("f_har", {"win_pct_by_rest_bucket": 0.5}, {"rest_bucket_win_pct_diff": "win_pct_by_rest_bucket"}))
cte("road", "select * from tg where not is_home")
for _k in (5, 10):
    cte(f"f_road{_k}", last_n("road", "road", _k, {"p": "avg(is_win)", "c": "count(*)", "d": "avg(margin)"}, ["team_id"]))
add("int_team_road_perf", f"select {IDS}, " + ", ".join(
    f"{r(f'case when f{k}.c >= {m} then f{k}.p else 0.5 end')} as away_recent_road_win_pct_{k}, coalesce(f{k}.c, 0) as away_recent_road_game_count_{k}, {r(f'coalesce(f{k}.d, 0.0)')} as away_recent_road_avg_point_diff_{k}"
    for k, m in ((5, 3), (10, 5))) + " from played g left join f_road5 f5 on f5.game_id = g.game_id left join f_road10 f10 on f10.game_id = g.game_id")

_dc = "p.winner_team_id is not null"
cte("f_clutch", hist("tg", split("clutch_", f"{_dc} and abs(p.margin) <= 5"), ["team_id", "yr"]))
add("int_team_clutch_perf", sides("f_clutch", defaults("clutch_")))
cte("f_blow", hist("tg", {**split("blowout_", f"{_dc} and abs(p.margin) > 15"), "blowout_frequency": f"avg(case when {_dc} then (abs(p.margin) > 15)::int end)"}, ["team_id"], 90))
add("int_team_blowout_perf", sides("f_blow", {**defaults("blowout_"), "blowout_frequency": 0.0}))
cte("f_cb", hist("tg", {**split("comeback_", f"{_dc} and abs(p.margin) <= 5"), **split("closeout_", f"{_dc} and abs(p.margin) > 10")}, ["team_id"], 90))
add("int_team_cb_closeout_perf", sides("f_cb", defaults("comeback_", "closeout_")))
cte("f_ot", hist("tg", {**split("overtime_", "p.is_overtime"), "overtime_win_pct": f"avg(case when p.is_overtime and {_dc} then p.is_win end)"}, ["team_id", "yr"]))
add("int_team_ot_perf", sides("f_ot", defaults("overtime_"), base="played"))

cte("q4", """select t.game_id, t.game_date, t.team_id, t.is_home, t.is_win, b.q4_points, b.q4_points - o.q4_points as q4_net_rating, (b.q4_points > o.q4_points)::int as won_q4
 from tgd t join v_team_boxscores b on b.game_id = t.game_id and b.team_id = t.team_id join v_team_boxscores o on o.game_id = t.game_id and o.team_id <> t.team_id""")
_UC = "over (partition by team_id order by game_date, game_id rows unbounded preceding)"
add("int_team_4q_perf", "select team_id, game_date, game_id, is_home, q4_points, q4_net_rating, won_q4, " + ", ".join(
    f"{r(f'avg({c}) {over(-(k - 1), 0)}')} as rolling_{k}_q4_{n}" for k in (5, 10) for n, c in (("ppg", "q4_points"), ("net_rtg", "q4_net_rating"), ("win_pct", "won_q4"))) +
    f", {r(f'coalesce(avg(won_q4 * is_win) {_UC} / nullif(avg(won_q4) {_UC}, 0), 0.5)')} as season_q4_win_pct_when_won_q4, count(*) filter (where won_q4 = 1) {_UC} as q4_wins_count_season from q4")

_O, _OD = {}, {}
for _k in (5, 10):
    for _c, _e, _dv in (("avg_margin_in_wins", "avg(abs(margin)) filter (where is_win = 1)", 0.0), ("avg_margin_in_losses", "avg(abs(margin)) filter (where is_win = 0)", 0.0),
                        ("close_game_win_pct", "avg(is_win) filter (where abs(margin) <= 5)", 0.5), ("blowout_game_win_pct", "avg(is_win) filter (where abs(margin) > 15)", 0.5)):
        _O[f"{_c}_{_k}"] = f"{_e} {over(-_k, -1)}"
        _OD[f"{_c}_{_k}"] = _dv
cte("f_oc", f"select game_id, is_home, {', '.join(f'{e} as {k}' for k, e in _O.items())} from tgd")
add("int_team_outcome_qual", sides("f_oc", _OD, base="played"))

_fav, _dog = f"{_dc} and p.now10 > p.o_now10", f"{_dc} and p.now10 < p.o_now10"
cte("f_ur0", hist("ctx", {"favorite_win_pct": f"avg(case when {_fav} then p.is_win end)", "favorite_game_count": f"count(case when {_fav} then 1 end)",
                          "underdog_win_pct": f"avg(case when {_dog} then p.is_win end)", "underdog_game_count": f"count(case when {_dog} then 1 end)"}, ["team_id", "yr"]))
cte("f_ur", "select *, (favorite_win_pct - 0.5) + (underdog_win_pct - 0.3) as upset_resistance_score from f_ur0")
add("int_team_upset_resistance", sides("f_ur", {"favorite_win_pct": 0.5, "favorite_game_count": 0, "underdog_win_pct": 0.3, "underdog_game_count": 0, "upset_resistance_score": 0.0}))
_up = f"{_dc} and cast(p.o_wp10 as decimal(9,3)) - cast(p.wp10 as decimal(9,3)) > 0.2"
cte("f_fu", hist("ctx", {**split("", f"{_dc} and p.wp10 > p.o_wp10", ("win_pct_when_favored", "favored_game_count", "avg_point_diff_when_favored")),
                         **split("", f"{_dc} and p.wp10 < p.o_wp10", ("win_pct_when_underdog", "underdog_game_count", "avg_point_diff_when_underdog")),
                         "upset_rate": f"avg(case when {_up} then p.is_win end)", "upset_game_count": f"count(case when {_up} then 1 end)"}, ["team_id"], 90))
add("int_team_favored_underdog_perf", sides("f_fu", {"win_pct_when_favored": 0.5, "favored_game_count": 0, "win_pct_when_underdog": 0.5, "underdog_game_count": 0,
    "avg_point_diff_when_favored": 0.0, "avg_point_diff_when_underdog": 0.0, "upset_rate": 0.0, "upset_game_count": 0}))

_PH = {"early_season": (0, 20), "mid_season": (20, 60), "late_season": (60, 82), "playoff_push": (72, 82)}
cte("num_rows", "select *, row_number() over (partition by season, team_id, is_home order by game_date, game_id) as num from tgd")
_pa, _pd = {}, {}
for _p, (_lo, _hi) in _PH.items():
    _pa |= split(f"{_p}_", f"p.num > {_lo} and p.num <= {_hi}")
    _pd |= defaults(f"{_p}_")
cte("f_time", hist("num_rows", {**_pa, **{f"is_{p}": f"max((a.num > {lo} and a.num <= {hi})::int)" for p, (lo, hi) in _PH.items()}}, ["season", "team_id", "is_home"]))
add("int_team_timing_perf", sides("f_time", _pd, {f"{p}_{c}_diff": f"{p}_{c}" for p in _PH for c in ("win_pct", "avg_point_diff")}, base="finished",
    extra="".join(f", {s[0]}.is_{p} as is_{s}_{p}" for s in ("home", "away") for p in _PH)))

cte("stand", f"""select d.game_date, t.team_id, {_n('t.is_win = 1')} as wins, count(*) as g, {h('sum(t.is_win) / count(*)', 3)} as win_pct from (select distinct game_date from played) d join tg t on t.game_date <= d.game_date group by 1, 2""")
cte("stand2", "select *, row_number() over (partition by game_date order by win_pct desc, wins desc, team_id) as overall_rank from stand")
cte("cut16", "select game_date, win_pct as cp, wins as cw from stand2 where overall_rank = 16")
add("int_team_playoff_ctx", f"""select s.game_date, s.team_id, s.overall_rank, (s.overall_rank <= 16)::int as is_in_playoff_position, greatest(0, coalesce(c.cw, 0) - s.wins) as games_back_from_cutoff,
 {r('s.win_pct - coalesce(c.cp, 0.0)')} as win_pct_diff_from_cutoff, (greatest(0, coalesce(c.cw, 0) - s.wins) <= 3)::int as is_close_to_cutoff, (s.overall_rank between 12 and 20)::int as is_fighting_for_playoff_spot
 from stand2 s left join cut16 c using (game_date)""")

# Trends.
cte("todate", f"select game_id, team_id, avg(points) {_U} as sp, avg(opponent_points) {_U} as so, avg(is_win) {_U} as sw, count(*) {_U} as n from box")


def _fd(k):
    return (f"{r(f'x.rolling_{k}_win_pct - s.sw')} as form_divergence_win_pct_{k}, {r(f'x.rolling_{k}_ppg - s.sp')} as form_divergence_ppg_{k}, {r(f'x.rolling_{k}_opp_ppg - s.so')} as form_divergence_opp_ppg_{k}, "
            f"{r(f'(x.rolling_{k}_ppg - x.rolling_{k}_opp_ppg) - (s.sp - s.so)')} as form_divergence_net_rtg_{k}, {r(f'abs(x.rolling_{k}_win_pct - s.sw)')} as form_divergence_magnitude_win_pct_{k}, (s.n >= {k})::int as has_sufficient_games_{k}")


add("int_team_form_divergence", f"select x.game_id, x.team_id, x.game_date, {_fd(5)}, {_fd(10)} from int_team_rolling_stats x join todate s using (game_id, team_id) where s.n >= 5")
_TM = {"win_pct": 1, "net_rtg": 1, "ppg": 1, "off_rtg": 1, "efg_pct": 1, "ts_pct": 1, "opp_ppg": -1, "def_rtg": -1}
add("int_team_perf_trends", "select team_id, game_date, game_id, " + ", ".join(f"{r(f'{s} * (rolling_5_{k} - rolling_10_{k})')} as {k}_trend" for k, s in _TM.items()) + " from int_team_rolling_stats")
_3 = over(-2, 0)
cte("three", f"""select b.game_id, b.team_id, b.game_date, avg(b.is_win) {_3.replace('by team_id', 'by b.team_id').replace('game_date, game_id', 'b.game_date, b.game_id')} as r_win_pct,
 avg(points - opponent_points) over q as r_net_rtg, avg(points) over q as r_ppg, avg(opponent_points) over q as r_opp_ppg, 100.0 * avg(points) over q / avg(possessions) over q as r_off_rtg,
 100.0 * avg(opponent_points) over q / avg(possessions) over q as r_def_rtg, avg(efg_pct) over q as r_efg_pct, avg(ts_pct) over q as r_ts_pct
 from box b where winner_team_id is not null and exists (select 1 from int_team_rolling_stats x where x.game_id = b.game_id and x.team_id = b.team_id)
 window q as (partition by b.team_id order by b.game_date, b.game_id rows between 2 preceding and current row)""")
add("int_team_recent_momentum", "select t.team_id, t.game_date, t.game_id, " + ", ".join(f"{r(f'{s} * (t.r_{k} - x.rolling_5_{k})')} as recent_{k}_momentum" for k, s in _TM.items()) +
    " from three t join int_team_rolling_stats x using (game_id, team_id)")
for _k in (3, 5):
    cte(f"last{_k}", last_n("tg", "tgd", _k, {f"w{_k}": "avg(is_win)", f"d{_k}": "avg(margin)"}, ["team_id"]))
cte("f_last", "select game_id, is_home, coalesce(d3, 0.0) - coalesce(d5, 0.0) as momentum_acceleration, coalesce(w3, 0.5) - coalesce(w5, 0.5) as form_trend_win_pct, coalesce(d3, 0.0) - coalesce(d5, 0.0) as form_trend_point_diff from last3 join last5 using (game_id, is_home)")
add("int_team_mom_accel", sides("f_last", {"momentum_acceleration": 0.0}, {"momentum_acceleration_diff": "momentum_acceleration"}, base="played"))
add("int_team_recent_form_trend", sides("f_last", {"form_trend_win_pct": 0.0, "form_trend_point_diff": 0.0}, {"form_trend_win_pct_diff": "form_trend_win_pct", "form_trend_point_diff_diff": "form_trend_point_diff"}, base="played"))
_n3, _o3 = over(-3, -1), over(-6, -4)


def _net(w):
    return f"coalesce(100.0 * (avg(points) {w} - avg(opponent_points) {w}) / avg(possessions) {w}, 0.0)"


def _gain(c):
    return f"coalesce(avg({c}) {_n3} - avg({c}) {_o3}, 0.0)"


add("int_team_perf_accel", f"""select team_id, game_date, game_id, {r(_gain('is_win'))} as win_pct_acceleration, {r(_gain('points - opponent_points'))} as point_diff_acceleration, {r(_gain('points'))} as ppg_acceleration,
 {r('-' + _gain('opponent_points'))} as defensive_acceleration, {r(f'{_net(_n3)} - {_net(_o3)}')} as net_rtg_acceleration, (avg(is_win) {_n3} is not null and avg(is_win) {_o3} is not null)::int as has_acceleration_data from box""")
_C = {}
for _k in (10, 5):
    _w = over(-(_k - 1), -1)
    _C |= {f"win_consistency_{_k}": f"stddev_samp(is_win) {_w}", f"point_diff_consistency_{_k}": f"stddev_samp(margin) {_w}", f"points_consistency_{_k}": f"stddev_samp(pts) {_w}",
           f"opp_points_consistency_{_k}": f"stddev_samp(opp_pts) {_w}", f"points_cv_{_k}": f"stddev_samp(pts) {_w} / avg(pts) {_w}", f"opp_points_cv_{_k}": f"stddev_samp(opp_pts) {_w} / avg(opp_pts) {_w}"}
cte("f_cons", f"select game_id, is_home, {', '.join(f'{e} as {k}' for k, e in _C.items())} from tg")
add("int_team_perf_consistency", sides("f_cons", {k: 0.0 for k in _C}, {f"{k}_diff": k for k in _C}))

cte("league30", """select median(rolling_10_pace) as mp, median(rolling_10_off_rtg) as mo, median(rolling_10_def_rtg) as md from int_team_rolling_stats where game_date >= (select max(game_date) from games) - 30""")
cte("styled", "select c.*, coalesce(o_pace10, 95.0) > mp as fast, coalesce(o_pace10, 95.0) < mp as slow, coalesce(o_off10, 110.0) > mo as hi, coalesce(o_def10, 110.0) < md as dfn from ctxd c, league30")
_S = {"fast_paced": "fast", "slow_paced": "slow", "high_scoring": "hi", "defensive": "dfn"}
cte("f_style", last_n("tg", "styled", 20, {f"win_pct_vs_{k}": f"avg(case when {c} then is_win end)" for k, c in _S.items()}, ["team_id", "is_home", "yr"]))
add("int_team_matchup_perf", sides("f_style", {f"win_pct_vs_{k}": 0.5 for k in _S}, base="played"))

cte("rctx", """select *, case when is_home then is_win else case when winner_team_id = opp_id then 0 else 1 end end as w2, case when back_to_back_with_travel and o_back_to_back_with_travel then true
 when back_to_back and o_back_to_back and not back_to_back_with_travel and not o_back_to_back_with_travel then true when rest_days >= 3 and o_rest_days >= 3 then true when rest_days = 2 and o_rest_days = 2 then true
 when rest_days <= 1 and o_rest_days <= 1 and not back_to_back and not o_back_to_back then true else false end as same from rested""")
cte("f_rc", hist("rctx", {"n": "count(case when p.same then 1 end)", "w": "sum(case when p.same then p.w2 end)", "d": "avg(case when p.same then p.margin end)", "same": "bool_or(a.same)"}, ["team_id", "is_home"]))
cte("f_rc2", "select game_id, is_home, case when n >= 5 then w / n end as win_pct_vs_similar_rest, d as avg_point_diff_vs_similar_rest, n as similar_rest_game_count, same from f_rc")
add("int_team_perf_vs_rest_ctx", sides("f_rc2", {"win_pct_vs_similar_rest": None, "avg_point_diff_vs_similar_rest": 0.0, "similar_rest_game_count": 0},
    {"win_pct_vs_similar_rest_diff": "win_pct_vs_similar_rest", "avg_point_diff_vs_similar_rest_diff": "avg_point_diff_vs_similar_rest"}, base="played",
    extra=", coalesce(h.same, false) as is_current_game_similar_rest_context", real=("win_pct_vs_similar_rest",)))

_SC = ("well_rested_vs_tired", "well_rested_vs_moderate", "moderate_vs_tired", "with_rest_advantage")
cte("scen", """select *, case when rest_days >= 3 and o_back_to_back then 'well_rested_vs_tired' when rest_days >= 3 and o_rest_days = 2 then 'well_rested_vs_moderate'
 when rest_days = 2 and o_back_to_back then 'moderate_vs_tired' when rest_days > o_rest_days then 'with_rest_advantage' end as sc from rested""")
_UV = "over (partition by team_id, is_home order by game_date, game_id rows between unbounded preceding and 1 preceding)"
_x, _xd = [], {}
for _s in _SC:
    _x += [f"avg(case when sc = '{_s}' then is_win end) {_UV} as win_pct_{_s}", f"avg(case when sc = '{_s}' then margin end) {_UV} as avg_point_diff_{_s}", f"count(case when sc = '{_s}' then 1 end) {_UV} as {_s}_count"]
    _xd |= {f"win_pct_{_s}": 0.5, f"avg_point_diff_{_s}": 0.0, f"{_s}_count": 0}
cte("f_sc", f"select game_id, is_home, sc, {', '.join(_x)} from scen")
add("int_team_perf_rest_adv", sides("f_sc", _xd, {f"win_pct_{s}_diff": f"win_pct_{s}" for s in _SC}, base="played", extra="".join(f", coalesce((h.sc = '{s}')::int, 0) as is_{s}" for s in _SC[:3]) +
    ", (coalesce(h.sc = 'with_rest_advantage', false) or coalesce(a.sc = 'with_rest_advantage', false))::int as is_rest_advantage_scenario"))
cte("f_combo", hist("rested_b", {"combo": "any_value(a.combo)", "win_pct_by_rest_combination": "avg(p.is_win)", "avg_point_diff_by_rest_combination": "avg(p.margin)", "rest_combination_count": "count(p.game_id)"}, ["team_id", "yr", "combo"]))
add("int_team_perf_by_rest_combo", sides("f_combo", {"win_pct_by_rest_combination": 0.5, "avg_point_diff_by_rest_combination": 0.0, "rest_combination_count": 0},
    {"rest_combination_win_pct_diff": "win_pct_by_rest_combination", "rest_combination_point_diff_diff": "avg_point_diff_by_rest_combination"}, extra=", h.combo as rest_combination_key"))

cte("meds", "select median(o) as mo, median(d) as md from (select distinct rolling_10_pace as p, rolling_10_off_rtg as o, rolling_10_def_rtg as d from int_team_rolling_stats)")
cte("compat", """select *, abs(pa - opa) as pg, abs((o - d) - (oo - od)) as ng from (select game_id, game_date, team_id, opp_id, cast(coalesce(pace10, 100) as decimal(9,1)) as pa, cast(coalesce(o_pace10, 100) as decimal(9,1)) as opa,
 cast(coalesce(off10, 100) as decimal(9,1)) as o, cast(coalesce(def10, 100) as decimal(9,1)) as d, cast(coalesce(o_off10, 100) as decimal(9,1)) as oo, cast(coalesce(o_def10, 100) as decimal(9,1)) as od from ctx where is_home)""")


def _step(x):
    return f"case when {x} <= 2 then 1.0 when {x} <= 5 then 0.75 when {x} <= 10 then 0.5 else 0.25 end"


def _fit(o, d):
    return f"case when {o} > mo and {d} < md then 1.0 when {o} > mo and {d} > md then 0.5 when {o} < mo and {d} < md then 0.5 else 0.0 end"


add("int_team_matchup_compat", f"""select game_id, game_date, team_id as home_team_id, opp_id as away_team_id, {r('pg')} as pace_difference, {r(_step('pg'))} as pace_compatibility_score, {r(_fit('o', 'od'))} as home_off_vs_away_def_compatibility,
 {r(_fit('oo', 'd'))} as away_off_vs_home_def_compatibility, {r(f"({_fit('o', 'od')}) - ({_fit('oo', 'd')})")} as style_matchup_advantage, {r('ng')} as net_rtg_difference, {r(_step('ng'))} as net_rtg_compatibility_score from compat, meds""")

cte("gpace", "select game_id, any_value(yr) as gy, round(sum(possessions) / 2.0, 6) as gp from box where winner_team_id is not null group by 1 having count(*) = 2")
cte("gmed", "select gy, median(gp) as med from gpace group by 1")
cte("paced", "select t.*, gp, med from tg t left join gpace using (game_id) left join gmed on gmed.gy = t.yr")
cte("f_pace", hist("paced", {**split("fast_pace_", "p.gp > p.med"), **split("slow_pace_", "p.gp <= p.med")}, ["team_id", "yr"]))
add("int_team_perf_by_pace_ctx", sides("f_pace", defaults("fast_pace_", "slow_pace_")))

cte("wl", "select *, lag(case when winner_team_id is not null then is_win = 1 end) over q as pw, lag(margin) over q as pm from tg window q as (partition by team_id order by game_date, game_id)")
_wa, _wd = {}, {}
for _k, _c in (("win", "p.pw"), ("loss", "not p.pw"), ("big_win", "p.pm > 10"), ("big_loss", "p.pm < -10")):
    _wa |= split("", _c, (f"win_pct_after_{_k}", f"game_count_after_{_k}", f"avg_point_diff_after_{_k}"))
    _wd |= {f"win_pct_after_{_k}": 0.5, f"avg_point_diff_after_{_k}": 0.0, f"game_count_after_{_k}": 0}
cte("f_wl", hist("wl", {**_wa, "is_coming_off_win": "max(coalesce(a.pw, false)::int)", "prev_game_margin": "cast(max(a.pm) as double)"}, ["team_id"]))
add("int_team_perf_after_wl", sides("f_wl", {**_wd, "is_coming_off_win": 0, "prev_game_margin": 0.0}, base="played", ids="g.game_id"))
