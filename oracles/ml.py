"""Check queries of the learning, scoring and analysis jobs."""

from __future__ import annotations

from . import assembly  # noqa: F401  (loads its CTEs)
from .sql import cte, h, hist, r

SQL: dict[str, str] = {}

_DIFFS = {"win_pct_diff_10": "wp10", "net_rtg_diff_10": "nr10", "off_rtg_diff_10": "off10", "def_rtg_diff_10": "def10", "pace_diff_10": "pace10"}
_FEATS = [*_DIFFS, "home_rest_days", "away_rest_days", "rest_advantage", "home_back_to_back", "home_injury_impact_score", "away_injury_impact_score", "injury_impact_diff",
          "home_injury_impact_ratio", "away_injury_impact_ratio", "injury_advantage_home"]
cte("lm", f"""select c.game_id, c.game_date, case when c.winner_team_id is not null then c.is_win end as home_win, c.pts as home_score, c.opp_pts as away_score, {', '.join(f'c.{k} - c.o_{k} as {n}' for n, k in _DIFFS.items())},
 d.home_rest_days, d.away_rest_days, d.rest_advantage, d.home_back_to_back, i.home_injury_impact_score, i.away_injury_impact_score, i.injury_impact_diff,
 case when c.wp10 > 0 then i.home_injury_impact_score / (c.wp10 * 100) else 0.0 end as home_injury_impact_ratio, case when c.o_wp10 > 0 then i.away_injury_impact_score / (c.o_wp10 * 100) else 0.0 end as away_injury_impact_ratio,
 least(3000.0, greatest(-3000.0, -i.injury_impact_diff)) as injury_advantage_home from ctx c join int_team_rest_days d on d.game_id = c.game_id join int_game_injury_features i on i.game_id = c.game_id where c.is_home""")
_MISS = " + ".join(f"({c} is null)::int" for c in _FEATS)
cte("trn", f"""select game_id, game_date, home_win, home_score, away_score, {', '.join(f'coalesce({c}{"::int" if c == "home_back_to_back" else ""}, 0)::double as {c}' for c in _FEATS)} from lm
 where game_date >= date '1995-06-01' and game_date < date '2001-06-01' and home_win is not null and ({_MISS}) / {float(len(_FEATS))} <= 0.15""")
SQL["ml_training_rows"] = f"select game_id, game_date, home_win, home_score, away_score, {', '.join(f'{r(c)} as {c}' for c in _FEATS)} from trn"
_X = {"win_pct_diff_10": "win_pct_diff_10", "net_rtg_diff_10": "net_rtg_diff_10", "off_rtg_diff_10": "off_rtg_diff_10", "def_rtg_diff_10": "def_rtg_diff_10", "rest_advantage": "rest_advantage", "injury_impact_diff": "injury_impact_diff",
      "home_rolling_5_apg": "home_injury_impact_score", "home_rolling_5_possessions": "away_rest_days", "injury_impact_diff_x_rest_advantage": "injury_impact_diff * rest_advantage", "injury_impact_diff_x_win_pct_diff_10": "injury_impact_diff * win_pct_diff_10",
      "win_pct_diff_10_x_rest_advantage": "win_pct_diff_10 * rest_advantage", "net_rtg_diff_10_x_rest_advantage": "net_rtg_diff_10 * rest_advantage", "off_rtg_diff_10_x_def_rtg_diff_10": "off_rtg_diff_10 * def_rtg_diff_10",
      "home_rolling_5_assist_rate": "coalesce(100.0 * home_injury_impact_score / nullif(away_rest_days, 0), 0.0)"}
SQL["ml_interactions"] = "select game_id, " + ", ".join(f"{r(e)} as {n}" for n, e in _X.items()) + " from trn"
SQL["ml_split_by_day"] = "select game_id, game_date, case when game_date < date '2000-01-01' then 'train' else 'test' end as part from trn"
SQL["ml_split_by_time"] = "select game_id, game_date, case when row_number() over (order by game_date, game_id) <= count(*) over () - floor(count(*) over () * 0.2) then 'train' else 'test' end as part from trn"


def _hash(seed):
    return f"cast(concat('0x', substr(md5(game_id || '/{seed}'), 1, 7)) as bigint) / 268435456.0"


SQL["ml_split_random"] = f"select game_id, home_win, case when {_hash(42)} >= 0.2 then 'train' else 'test' end as part, case when {_hash(7)} >= 0.15 then 'fit' else 'validation' end as part_of_train from trn"
_B = [c for c in _FEATS if "_ratio" in c or "injury" in c]
cte("wt0", "select game_id, 1.0 + " + " + ".join(f"coalesce(abs({c}) / nullif(max(abs({c})) over (), 0), 0) * 0.5" for c in _B) + " as w from trn")
SQL["ml_sample_weights"] = f"select game_id, {r('greatest(0.5, least(2.0, w / avg(w) over ()))')} as weight from wt0"
cte("pred", f"""select game_id * 10 as prediction_id, game_id, 'm' || game_id % 2 as model_id, p as p_home, (p >= 0.5)::int as predicted_value, greatest(p, 1 - p) as base_confidence, home_win, home_injury_impact_ratio, away_injury_impact_ratio, injury_advantage_home
 from (select *, {h('1 / (1 + exp(-(coalesce(net_rtg_diff_10, 0) * 0.08 + coalesce(win_pct_diff_10, 0) * 1.5)))', 6)} as p from lm)""")
cte("predw", "select * from pred where home_win is not null")
cte("crep", """select l as label, count(*) filter (where home_win = l and predicted_value = l) as hits, count(*) filter (where predicted_value = l) as predicted, count(*) filter (where home_win = l) as actual from predw, (values (0), (1)) t(l) group by 1""")
SQL["ml_class_report"] = f"select label, hits, predicted, actual, {r('coalesce(hits / nullif(predicted, 0), 0)')} as precision, {r('coalesce(hits / nullif(actual, 0), 0)')} as recall, {r('coalesce(2.0 * hits / nullif(predicted + actual, 0), 0)')} as f1 from crep"
cte("cbins", "select cast(least(floor(p_home * 10), 9) as int) as bin, count(*) as n, avg(p_home) as mean_predicted, avg(home_win::double) as observed from predw group by 1")
SQL["ml_calibration_bins"] = f"select bin, n, {r('mean_predicted')} as mean_predicted, {r('observed')} as observed from cbins"
SQL["ml_calibration_error"] = f"select {r('(select avg(pow(p_home - home_win, 2)) from predw)')} as brier, {r('(select avg(abs(observed - mean_predicted)) from cbins)')} as calibration_error"
SQL["ml_games_to_score"] = """select game_id, game_date, 'future' as mode from games where game_date >= date '1999-01-01' and home_score is null union all select game_id, game_date, 'day' from games where game_date = date '1999-01-05'
 union all select game_id, game_date, 'range' from games where game_date between date '1999-01-01' and date '1999-02-01' and home_score is not null"""
cte("sc0", "select *, greatest(abs(coalesce(home_injury_impact_ratio, 0)), abs(coalesce(away_injury_impact_ratio, 0))) as top, abs(coalesce(injury_advantage_home, 0)) as adv from pred where base_confidence >= 0.55")
cte("scd", "select *, greatest(0.1, least(1.0, base_confidence * (1 - case when top > 20 then least(0.4, (top - 20) / 50) when top > 10 then (top - 10) / 50 else 0 end) * (1 - case when adv > 1000 then least(0.15, (adv - 1000) / 10000) else 0 end))) as confidence from sc0")
SQL["ml_scored"] = f"select prediction_id, game_id, predicted_value, {r('base_confidence')} as base_confidence, {r('confidence')} as confidence from scd"
cte("ev0", """select count(*) as predictions, avg((predicted_value = home_win)::int) as accuracy, count(*) filter (where predicted_value = 1 and home_win = 1) as tp, count(*) filter (where predicted_value = 1 and home_win = 0) as fp, count(*) filter (where predicted_value = 0 and home_win = 1) as fn,
 count(*) filter (where predicted_value = 0 and home_win = 0) as tn, avg(confidence) as mean_confidence from scd where home_win is not null""")
SQL["ml_evaluation"] = f"""select predictions, {r('accuracy')} as accuracy, tp, fp, fn, tn, {r('mean_confidence')} as mean_confidence, {r('tp / (tp + fp)')} as precision, {r('tp / (tp + fn)')} as recall, {r('2.0 * tp / (2 * tp + fp + fn)')} as f1, {r('tn / (tn + fp)')} as upset_accuracy, {r('tp / (tp + fp)')} as home_win_accuracy from ev0 where predictions >= 10"""
SQL["ml_store_outcomes"] = "select prediction_id, home_win as actual_value, predicted_value = home_win as is_correct from scd where home_win is not null union all select prediction_id, null, null from scd where home_win is null and game_id % 3 = 0"
_CF = ["win_pct_diff_10", "net_rtg_diff_10", "off_rtg_diff_10", "def_rtg_diff_10", "pace_diff_10", "home_rest_days", "rest_advantage", "home_injury_impact_score", "injury_impact_diff"]
cte("cpairs", "select * from (" + " union all ".join(f"select '{a}' as feature_1, '{b}' as feature_2, abs(corr({a}, {b})) as correlation from trn" for i, a in enumerate(_CF) for b in _CF[i + 1:]) + ") where correlation >= 0.5")
SQL["ml_correlated_pairs"] = f"select feature_1, feature_2, {r('correlation')} as correlation from cpairs"
cte("tcorr", " union all ".join(f"select '{a}' as feature, abs(corr({a}, home_win)) as correlation from trn" for a in _CF))
SQL["ml_target_correlation"] = f"select feature, {r('correlation')} as correlation from tcorr"
cte("topp", "select * from cpairs order by correlation desc, feature_1, feature_2 limit 10")
SQL["ml_removal_advice"] = f"""select 'high_correlation' as kind, case when a.correlation > b.correlation then feature_2 else feature_1 end as feature, case when a.correlation > b.correlation then feature_1 else feature_2 end as alternative, {r('t.correlation')} as value
 from topp t left join tcorr a on a.feature = feature_1 left join tcorr b on b.feature = feature_2 union all select 'low_importance', feature, null, {r('correlation / 10')} from (select * from tcorr where correlation / 10 < 0.002 order by correlation, feature limit 10)"""
_L = {"win_pct_diff_10": 1.5, "net_rtg_diff_10": 0.08, "rest_advantage": 0.02, "injury_impact_diff": -0.001}
cte("contr", " union all ".join(f"select game_id, '{c}' as feature, {w} * ({c} - (select avg({c}) from trn)) as contribution from trn" for c, w in _L.items()))
SQL["ml_contributions"] = f"select game_id, feature, {r('contribution')} as contribution from contr"
cte("contg", "select game_id, case when feature in ('win_pct_diff_10', 'net_rtg_diff_10') then 'form' when feature = 'rest_advantage' then 'rest' else 'injury' end as grp, sum(contribution) as c from contr group by 1, 2")
SQL["ml_mean_contributions"] = f"select grp, {r('avg(abs(c))')} as mean_abs_contribution, {r('avg(c)')} as mean_contribution from contg group by 1"

cte("pe0", "select s.*, g.game_date, (g.home_score > g.away_score)::int as y from scd s join games g on g.game_id = s.game_id where g.home_score is not null")
SQL["an_prediction_errors"] = "select game_date, count(*) as total, count(*) filter (where predicted_value = y) as correct, count(*) filter (where predicted_value <> y and confidence > 0.7) as sure_wrong, count(*) filter (where predicted_value = y and confidence < 0.6) as unsure_right from pe0 group by 1"
SQL["an_wrong_by_injury"] = f"select s.game_id, {r('s.confidence')} as confidence, s.predicted_value, l.home_win, {r('abs(l.home_injury_impact_ratio)')} as home_ratio, {r('abs(l.away_injury_impact_ratio)')} as away_ratio, {r('l.injury_impact_diff')} as injury_impact_diff, {r('l.win_pct_diff_10')} as win_pct_diff_10 from scd s join lm l on l.game_id = s.game_id where s.predicted_value <> l.home_win"
cte("recs", hist("tg", {"g": "count(p.game_id)", "w": "sum(p.is_win)", "me": "max(a.is_win)"}, ["team_id"]))
SQL["an_upset_types"] = """select h.game_id, p.game_date, case when h.g = 0 or a.g = 0 then 'Unknown' when h.w / h.g < a.w / a.g and h.me = 1 then 'Home Upset' when a.w / a.g < h.w / h.g and a.me = 1 then 'Away Upset' else 'Expected' end as upset_type
 from recs h join recs a on a.game_id = h.game_id and not a.is_home join played p on p.game_id = h.game_id where h.is_home"""
SQL["an_latest_model"] = "select prediction_id, model_id, 'winner' as model_name, '1.1' as model_version from scd where model_id = 'm1'"
SQL["an_compare_versions"] = f"select game_id, 2 as versions, case when game_id % 4 = 0 then 2 else 1 end as answers, {r('confidence * 0.9')} as min_confidence, {r('confidence')} as max_confidence from scd"
cte("odds", "select cast(game_id as varchar) as game_id, 'BookA' as book_name, 1 + game_id % 7 * 0.25::double as home_odds, (1 + game_id % 5 * 0.5::double) * case when game_id % 3 = 0 then 100 when game_id % 3 = 1 then -100 else 1 end as away_odds from v_games")
SQL["an_latest_odds"] = f"""select *, {r('case when away_odds > 0 and away_odds < 10 then 10 * away_odds - 10 when away_odds > 0 then 10 * away_odds / 100 else 1000 / abs(away_odds) end')} as profit,
 case when away_odds > 0 and away_odds < 10 then 'decimal' when away_odds > 0 then 'american_underdog' else 'american_favorite' end as odds_format from odds"""
SQL["an_matchup_report"] = f"""select t.team_id, count(*) as games, cast(sum(t.is_win) as bigint) as wins, {r('avg(t.margin)')} as avg_margin, date '1999-06-01' - max(t.game_date) as rest_days,
 (select count(*) from tg q where q.team_id = t.team_id and q.team_id in (3, 7) and q.opp_id in (3, 7) and q.game_date < date '1999-06-01') as head_to_head,
 (select coalesce(cast(sum(q.is_win) as bigint), 0) from tg q where q.team_id = t.team_id and q.team_id in (3, 7) and q.opp_id in (3, 7) and q.game_date < date '1999-06-01') as head_to_head_wins
 from (select *, row_number() over (partition by team_id order by game_date desc, game_id desc) as k from tg where team_id in (3, 7) and game_date < date '1999-06-01') t where k <= 10 group by 1"""
SQL["an_key_players"] = """select b.game_id, b.team_id, b.player_id, try_cast(substr(b.minutes, 3, strpos(b.minutes, 'M') - 3) as double) + 0.5::double as minutes_played from v_player_boxscores b join games g on g.game_id = b.game_id
 where g.game_date = date '1999-03-01' and (g.home_team_id in (3, 7) or g.away_team_id in (3, 7)) and b.team_id in (3, 7) and b.minutes like 'PT%M30S' and try_cast(substr(b.minutes, 3, strpos(b.minutes, 'M') - 3) as double) + 0.5 > 12"""
cte("zs", " union all ".join(f"select t.game_id, '{c}' as feature, t.{c} as value, s.m as mean, s.sd from trn t, (select avg({c}) as m, stddev_samp({c}) as sd from trn) s where t.game_date = date '1999-03-01'" for c in _CF))
SQL["an_against_history"] = f"select game_id, feature, {r('value')} as value, {r('mean')} as mean, {r('sd')} as sd, {r('(value - mean) / nullif(sd, 0)')} as z, coalesce(abs((value - mean) / nullif(sd, 0)) > 2, false) as is_extreme from zs"
cte("il", """select g.game_id, g.team_id, i.injury_id, p.player_id, i.status, s.player_tier, s.impact_score, i.capture_date from gsides g join people p on p.team_id = g.team_id join v_injuries i on i.player_name = p.player_name and i.capture_date <= g.game_date and i.capture_date >= g.game_date - 7
 left join stars s on s.player_id = p.player_id where i.status not in ('N/A', 'Active')""")
SQL["an_injury_list"] = f"select * replace ({r('impact_score')} as impact_score), row_number() over (partition by game_id, team_id order by capture_date desc nulls last, impact_score desc nulls last, injury_id) as rank from il"
SQL["an_injury_bands"] = f"""select case when x > 2 then 'Large Home Advantage' when x > 0.5 then 'Moderate Home Advantage' when x > -0.5 then 'Neutral' when x > -2 then 'Moderate Away Advantage' else 'Large Away Advantage' end as injury_advantage, count(*) as games, cast(sum(home_win) as bigint) as home_wins, {r('avg(home_win)')} as home_win_pct
 from (select *, injury_impact_diff / 100 as x from lm) where game_date >= date '1996-01-01' and x <> 0 group by 1"""
_H, _Aw = "home_injury_impact_score", "away_injury_impact_score"
SQL["an_injury_distribution"] = f"""select count(*) as games, count(*) filter (where {_H} > 0) as with_home_impact, count(*) filter (where {_Aw} > 0) as with_away_impact, count(*) filter (where injury_impact_diff <> 0) as with_diff, {r(f'avg({_H})')} as avg_home, {r(f'avg({_Aw})')} as avg_away,
 {r(f'stddev_samp({_H})')} as sd_home, {r(f'stddev_samp({_Aw})')} as sd_away, {r(f'max({_H})')} as max_home, {r(f'max({_Aw})')} as max_away from lm"""
