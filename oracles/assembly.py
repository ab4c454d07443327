"""Check queries of players, injuries, feature groups, mart and feature tables."""

from __future__ import annotations

from . import published as P
from .models import _T  # noqa: F401  (loads the model CTEs)
from .models import LOOKUP
from .sql import CTES, cte, h, r, sides

SQL: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    SQL[name] = sql
    cte(name, sql)


cte("apps", "select b.*, g.game_date as d from v_player_boxscores b join games g on g.game_id = b.game_id where g.is_completed and b.minutes like 'PT%'")
cte("stars", """select player_id, team_id, avg(points) as avg_ppg, avg(assists) as avg_apg, avg(rebounds) as avg_rpg, case when avg(points) >= 20 then 'star' else 'key_player' end as player_tier,
 avg(points) + avg(assists) * 0.5 + avg(rebounds) * 0.3 as impact_score from apps group by 1, 2 having count(distinct game_id) >= 10 and avg(points) >= 15""")
SQL["int_star_players"] = f"select player_id, team_id, {r('avg_ppg')} as avg_ppg, {r('avg_apg')} as avg_apg, {r('avg_rpg')} as avg_rpg, player_tier, {r('impact_score')} as impact_score from stars"
cte("avail", """select a.game_id, a.d as game_date, a.team_id, a.player_id, s.player_tier, s.impact_score, lag(a.d) over q as prev_game_date, a.d - lag(a.d) over q as gap
 from apps a join stars s on s.player_id = a.player_id and s.team_id = a.team_id window q as (partition by a.player_id, a.team_id order by a.d, a.game_id)""")
cte("avail2", """select *, (coalesce(gap, 0) >= 7)::int as is_return_game, (coalesce(gap, 0) >= 14)::int as is_extended_return_game, case when gap >= 14 and player_tier = 'star' then impact_score * 1.5 when gap >= 7 and player_tier = 'star' then impact_score * 1.2
 when gap >= 14 then impact_score * 1.3 when gap >= 7 then impact_score * 1.1 else 0.0 end as return_impact_score from avail""")
SQL["int_star_player_avail"] = f"select game_id, game_date, team_id, player_id, player_tier, {r('impact_score')} as impact_score, prev_game_date, gap as days_since_last_game, is_return_game, is_extended_return_game, {r('return_impact_score')} as return_impact_score from avail2"
cte("star_feats", """select game_id, game_date, team_id, cast(sum(case when is_return_game = 1 and player_tier = 'star' then 1 else 0 end) as bigint) as star_players_returning,
 cast(sum(case when is_return_game = 1 and player_tier = 'key_player' then 1 else 0 end) as bigint) as key_players_returning, cast(sum(is_extended_return_game) as bigint) as extended_returns, sum(return_impact_score) as total_return_impact,
 max(gap) filter (where is_return_game = 1) as max_days_since_return, avg(gap) filter (where is_return_game = 1) as avg_days_since_return,
 count(distinct player_id) filter (where player_tier = 'star') as star_players_playing, count(distinct player_id) filter (where player_tier = 'key_player') as key_players_playing from avail2 group by 1, 2, 3""")
cte("star_feats2", "select *, (star_players_returning > 0 or extended_returns > 0)::int as has_star_return, (extended_returns > 0)::int as has_extended_return from star_feats")
SQL["int_team_star_feats"] = f"select * replace ({r('total_return_impact')} as total_return_impact, {r('avg_days_since_return')} as avg_days_since_return) from star_feats2"

cte("people", "select distinct player_id, team_id, concat('Player ', player_id) as player_name, concat('T', team_id) as abbr from v_player_boxscores")
cte("reports", """select i.injury_id, i.capture_date, i.status, p.player_id, s.player_tier, s.impact_score, coalesce(t.team_id, p.team_id) as team_id,
 case when upper(i.status) like '%OUT%' then 'Out' when upper(i.status) like '%DOUBTFUL%' then 'Doubtful' when upper(i.status) like '%QUESTIONABLE%' then 'Questionable' when upper(i.status) like '%PROBABLE%' then 'Probable' else 'Out' end as st
 from v_injuries i join lateral (select p.player_id, p.team_id from people p where upper(trim(p.player_name)) = upper(trim(i.player_name)) and (i.team_abbrev = 'UNK' or i.team_abbrev = p.abbr) order by p.player_id desc limit 1) p on true
 join stars s on s.player_id = p.player_id left join v_teams t on t.team_abbreviation = i.team_abbrev where i.status <> 'N/A'""")
cte("team_days", "select distinct team_id, game_date from (select home_team_id as team_id, game_date from games union all select away_team_id, game_date from games)")
cte("known", """select d.team_id, d.game_date, q.* exclude (team_id) from team_days d join reports q on q.team_id = d.team_id and q.capture_date <= d.game_date + 1
 qualify row_number() over (partition by d.team_id, d.game_date order by q.capture_date desc, q.injury_id desc) <= 100""")


def _cd(s, t):
    return f"count(distinct case when st = '{s}' and player_tier = '{t}' then player_id end)"


_CNT = [f"{t}_players_{s}" for s in ("out", "doubtful", "questionable") for t in ("star", "key")]
cte("rep_feats", "select team_id, game_date, " + ", ".join(f"{_cd(s.capitalize(), 'star' if t == 'star' else 'key_player')} as {t}_players_{s}" for s in ("out", "doubtful", "questionable") for t in ("star", "key")) +
    """, sum(impact_score * case when st = 'Out' and player_tier = 'star' then 1.0 when st = 'Out' then 0.7 when st = 'Doubtful' and player_tier = 'star' then 0.6 when st = 'Doubtful' then 0.4 when st = 'Questionable' and player_tier = 'star' then 0.3 when st = 'Questionable' then 0.2 else 0 end) as injury_impact_score,
 count(distinct case when st in ('Out', 'Doubtful') then player_id end) as injured_players_count, max((st in ('Out', 'Doubtful'))::int) as has_key_injury from known group by 1, 2""")
cte("gsides", "select game_id, game_date, is_completed, home_team_id as team_id, true as is_home from games union all select game_id, game_date, is_completed, away_team_id, false from games")
cte("dnp", """select g.game_id, g.is_home, count(distinct case when s.player_tier = 'star' then s.player_id end) as so, count(distinct case when s.player_tier = 'key_player' then s.player_id end) as ko, sum(s.impact_score) as imp
 from gsides g join stars s on s.team_id = g.team_id where g.is_completed and not exists (select 1 from apps a where a.game_id = g.game_id and a.player_id = s.player_id) group by 1, 2""")
cte("f_inj", "select g.game_id, g.is_home, coalesce(nullif(p.star_players_out, 0), d.so, 0) as star_players_out, coalesce(nullif(p.key_players_out, 0), d.ko, 0) as key_players_out, " +
    ", ".join(f"coalesce(p.{c}, 0) as {c}" for c in _CNT[2:]) + """, coalesce(nullif(p.injury_impact_score, 0), d.imp, 0) as injury_impact_score,
 coalesce(nullif(p.injured_players_count, 0), d.so + d.ko, 0) as injured_players_count, coalesce(nullif(p.has_key_injury, 0), case when d.so + d.ko > 0 then 1 else 0 end, 0) as has_key_injury
 from gsides g left join rep_feats p on p.team_id = g.team_id and p.game_date = g.game_date left join dnp d on d.game_id = g.game_id and d.is_home = g.is_home""")
add("int_game_injury_features", sides("f_inj", {**{c: 0 for c in _CNT}, "injury_impact_score": 0.0, "injured_players_count": 0, "has_key_injury": 0},
    {"injury_impact_diff": "injury_impact_score", "star_players_out_diff": "star_players_out"}))
SQL["team_injury_features"] = """select capture_date, team_abbrev, count(*) as injured_players, """ + ", ".join(f"cast(sum((status = '{s}')::int) as bigint) as players_{s.lower()}" for s in ("Out", "Doubtful", "Questionable", "Probable")) + """,
 string_agg(player_name || ' (' || status || ')', ', ' order by player_name || ' (' || status || ')') as injury_list, timestamp '2024-01-01' as updated_at from v_injuries where status <> 'N/A' group by 1, 2"""

# Feature groups: the same joins, written by name, with the published defaults.


class _Cols:
    """Column names and kinds of the model checks, read from DuckDB on an empty database."""

    def __init__(self):
        self._con = None
        self._cache: dict[str, list[tuple[str, str]]] = {}

    def __call__(self, name: str) -> list[tuple[str, str]]:
        if name not in self._cache:
            from .sql import compose

            if self._con is None:
                import duckdb

                self._con = duckdb.connect()
                self._con.execute("create table orders (o_orderkey bigint, o_custkey bigint, o_orderdate date, o_totalprice double)")
                self._con.execute("create table lineitem (l_orderkey bigint, l_partkey bigint, l_linenumber bigint, l_quantity double, l_discount double, l_returnflag varchar)")
                self._con.execute("create table events (event_id bigint, user_id bigint, event_type varchar)")
                self._con.execute("create table nation (n_nationkey bigint, n_name varchar, n_regionkey bigint)")
                self._con.execute("create table region (r_regionkey bigint, r_name varchar)")
            self._cache[name] = [(d[0], str(d[1])) for d in self._con.execute(f"describe {compose('select * from ' + name)}").fetchall()]
        return self._cache[name]


columns = _Cols()
IDS = ("game_id", "game_date", "home_team_id", "away_team_id")


def group(parts: list[tuple[str, str, dict[str, str]]], diffs: dict[str, str]) -> str:
    """parts: (cte, join condition, column -> output name)."""
    cols, joins, expr = [], [], {}
    for i, (name, on, rename) in enumerate(parts):
        kinds = dict(columns(name))
        joins.append(f"left join {name} p{i} on {on.format(p=f'p{i}')}")
        for c, a in rename.items():
            x = f"coalesce(p{i}.{c}, {P.default(a, kinds[c])})"
            expr[a] = x
            cols.append(f"{r(x) if kinds[c] == 'DOUBLE' or kinds[c].startswith('DECIMAL') else x} as {a}")
    for n, c in diffs.items():
        cols.append(f"{r(expr['home_' + c] + ' - ' + expr['away_' + c])} as {n}")
    return f"select g.game_id, g.game_date, g.home_team_id, g.away_team_id, {', '.join(cols)} from games g {' '.join(joins)}"


GROUPS = ("int_momentum_group_basic", "int_momentum_group_h2h", "int_momentum_group_opponent", "int_momentum_group_context", "int_momentum_group_trends")
_BY_GAME = "{p}.game_id = g.game_id"


def whole(name: str, drop=(), rename=None):
    cols = {c: (rename or {}).get(c, c) for c, _ in columns(name) if c not in IDS and c not in drop}
    return (name, _BY_GAME, cols)


def by_side(name: str, rename: dict[str, str]):
    return [(name, f"{{p}}.game_id = g.game_id and {{p}}.team_id = g.{s}_team_id", {c: f"{s}_{a}" for c, a in rename.items()}) for s in ("home", "away")]


def _groups() -> None:
    add("int_momentum_group_basic", group([whole(n, ("win_streak_length_diff",)) for n in P.BASIC], {}))
    add("int_momentum_group_h2h", group([whole("int_team_h2h_stats", ("home_h2h_wins", "away_h2h_wins", "h2h_total_games")), whole("int_team_rivalry_ind"), whole("int_team_opp_specific_perf")], {}))
    add("int_momentum_group_opponent", group([whole(n, ("home_rest_bucket", "away_rest_bucket")) for n in P.OPPONENT], {f'{c}_diff': c for c in P.OPPONENT_DIFFS}))
    up = {f"{s}_underdog_game_count": f"{s}_underdog_game_count_upset" for s in ("home", "away")}
    parts = [whole(n, rename=up if n == "int_team_upset_resistance" else None) for n in P.CONTEXT] + by_side("int_team_4q_perf", {c: c for c in P.QUARTER})
    parts += [("int_team_playoff_ctx", f"{{p}}.game_date = g.game_date and {{p}}.team_id = g.{s}_team_id", {c: f"{s}_{a}" for c, a in P.RACE.items()}) for s in ("home", "away")]
    add("int_momentum_group_context", group(parts, {f'{c}_diff': c for c in P.CONTEXT_DIFFS}))
    parts = by_side("int_team_form_divergence", P.DIVERGENCE) + by_side("int_team_perf_trends", {f"{k}_trend": f"{k}_trend" for k in P.TREND_KEYS})
    parts += by_side("int_team_recent_momentum", {f"recent_{k}_momentum": f"recent_{k}_momentum" for k in P.TREND_KEYS}) + by_side("int_team_perf_accel", {c: c for c in P.ACCELERATIONS})
    parts += [whole(n, ("rest_combination_key",)) for n in P.TRENDS]
    add("int_momentum_group_trends", group(parts, {f'{c}_diff': c for c in P.TREND_DIFFS}))
    cte("int_game_momentum_features", "select b.*, " + ", ".join(f"{g[-5:]}.* exclude (game_id, game_date, home_team_id, away_team_id)" for g in GROUPS[1:]) + ", " +
        ", ".join(f"{s} as {n}" for n, s in P.ALIASES.items()) + f" from {GROUPS[0]} b " + " ".join(f"left join {g} {g[-5:]} on {g[-5:]}.game_id = b.game_id" for g in GROUPS[1:]))
    SQL["int_game_momentum_features"] = "select " + ", ".join(f"{r(c)} as {c}" if _real(k) else c for c, k in columns("int_game_momentum_features")) + " from int_game_momentum_features"


def _real(kind: str) -> bool:
    return kind == "DOUBLE" or kind.startswith("DECIMAL")


def _mart() -> None:
    roll = ", ".join(f"{s[0]}r.{c} as {s}_{c}" for s in ("home", "away") for c in LOOKUP if not c.startswith("wins_last") and c != "rolling_10_opp_ppg")
    ret = ", ".join(f"{f'coalesce({s[0]}f.{c}, {d})' if d is not None else f'{s[0]}f.{c}'} as {s}_{c}" for s in ("home", "away") for c, d in P.RETURNS.items())
    cte("mart1", f"""select g.game_id, g.game_date, g.home_team_id, g.away_team_id, case when g.winner_team_id = g.home_team_id then 1 else 0 end as home_win, g.home_score, g.away_score, g.home_score - g.away_score as point_spread,
 g.home_score + g.away_score as total_points, g.is_overtime, {roll}, {ret}, i.* exclude (game_id, game_date, home_team_id, away_team_id), m.* exclude (game_id, game_date, home_team_id, away_team_id, home_back_to_back_with_travel, away_back_to_back_with_travel),
 m.home_back_to_back_with_travel::int as home_back_to_back_with_travel, m.away_back_to_back_with_travel::int as away_back_to_back_with_travel,
 coalesce(u.away_upset_tendency_season, 0.3) as away_upset_tendency_season, coalesce(u.away_upset_tendency_rolling, 0.3) as away_upset_tendency_rolling, coalesce(u.away_upset_sample_size_season, 0) as away_upset_sample_size_season, coalesce(u.away_upset_sample_size_rolling, 0) as away_upset_sample_size_rolling,
 hs.win_pct as home_season_win_pct, hs.point_diff as home_season_point_diff, hs.home_wins as home_wins_at_home, hs.home_losses as home_losses_at_home, s.win_pct as away_season_win_pct, s.point_diff as away_season_point_diff, s.away_wins as away_wins_on_road, s.away_losses as away_losses_on_road
 from played g left join int_team_roll_lkp hr on hr.game_id = g.game_id and hr.team_id = g.home_team_id left join int_team_roll_lkp ar on ar.game_id = g.game_id and ar.team_id = g.away_team_id
 left join star_feats2 hf on hf.game_id = g.game_id and hf.team_id = g.home_team_id left join star_feats2 af on af.game_id = g.game_id and af.team_id = g.away_team_id
 left join int_game_injury_features i on i.game_id = g.game_id left join int_game_momentum_features m on m.game_id = g.game_id left join int_away_upset_tend u on u.game_id = g.game_id
 left join int_team_season_stats hs on hs.team_id = g.home_team_id left join int_team_season_stats s on s.team_id = g.away_team_id""")
    have = [c for c, _ in columns("mart1")]
    e = {f"{k}_diff_{n}": f"home_rolling_{n}_{k} - away_rolling_{n}_{k}" for n in (5, 10) for k in P.ROLLING_DIFFS if (n, k) != (10, "fg_pct")}
    e |= {"season_win_pct_diff": "home_season_win_pct - away_season_win_pct", "season_point_diff_diff": "home_season_point_diff - away_season_point_diff",
          "star_return_advantage": "home_has_star_return - away_has_star_return", "return_impact_diff": "home_total_return_impact - away_total_return_impact"}
    cte("mart2", f"select *, {', '.join(f'{x} as {n}' for n, x in e.items())} from mart1")
    more = {n: f'home_{c} - away_{c}' for n, c in P.MART_DIFFS.items() if n not in have} | P.MART_FORMULAS
    cte("mart3", f"select *, {', '.join(f'{x} as {n}' for n, x in more.items())} from mart2")
    cols = columns("mart3")
    SQL["mart_game_features"] = "select " + ", ".join(f"{r(c)} as {c}" if _real(k) else c for c, k in cols) + " from mart3"


_groups()
_mart()
SQL["game_feature_view"] = "select a.game_id, a.asked_on, " + ", ".join(
    [f"cast(null as double) as {c}" if c.endswith("_form_divergence") else f"{r('m.' + c)} as {c}" for c in P.VIEW_DOUBLES] + [f"cast(m.{c} as integer) as {c}" for c in P.VIEW_INTS] + [f"cast(m.{c} as boolean) as {c}" for c in P.VIEW_FLAGS]) + """
 from (select game_id, game_date + cast(game_id % 400 - 1 as integer) as asked_on from games) a left join mart3 m on m.game_id = a.game_id and a.asked_on - m.game_date between 0 and 365"""

cte("recent", "select t.team_id, t.is_win, t.winner_team_id, row_number() over (partition by t.team_id order by t.game_date desc, t.game_id desc) as k from tg t")
cte("recent20", "select *, case when winner_team_id is not null then is_win = 1 end as won from recent where k <= 20")
cte("streak20", """select team_id, any_value(f) as f, count(*) as n from (select q.*, first_value(won) over (partition by team_id order by k) as f, min(case when won is distinct from o.fw then k end) over (partition by team_id) as brk
 from recent20 q join (select team_id as tid, won as fw from recent20 where k = 1) o on o.tid = q.team_id) where brk is null or k < brk group by 1""")
cte("ten", "select team_id, count(*) filter (where won) as w10, count(*) filter (where not won) as l10 from recent20 where k <= 10 group by 1")
_O = "win_pct desc nulls last, point_diff desc nulls last"
SQL["mart_team_standings"] = f"""select s.team_id, t.team_name, t.team_abbreviation, t.conference, t.division, s.wins, s.losses, s.win_pct, rank() over (partition by conference order by {_O}) as conf_rank, rank() over (order by {_O}) as league_rank,
 s.home_wins, s.home_losses, s.away_wins, s.away_losses, s.ppg, s.opp_ppg, s.point_diff, s.fg_pct, s.fg3_pct, s.ft_pct, w10 as last_10_wins, l10 as last_10_losses, w10 || '-' || l10 as last_10, case when k.f then 'W' else 'L' end || k.n as streak,
 k.f as on_winning_streak, k.n as streak_length, {h('((first_value(wins) over q - wins) + (losses - first_value(losses) over q)) / 2.0', 1)} as games_back
 from int_team_season_stats s join v_teams t on t.team_id = s.team_id left join streak20 k on k.team_id = s.team_id left join ten on ten.team_id = s.team_id window q as (partition by conference order by {_O}, s.team_id)"""
SQL["team_features"] = "select * exclude (ot_games, first_game, last_game), timestamp '2024-01-01' as updated_at from int_team_season_stats"
