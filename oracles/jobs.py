"""Check queries of generic operators, keyed writes, quality and incremental runs."""

from __future__ import annotations

from .models import SQL as MODELS
from .sql import cte, h, hist, r

SQL: dict[str, str] = {}

_PUR = "select event_id, user_id, ts, value as amount from events where event_type = 'purchase'"
SQL["asof_events"] = f"""select p.event_id, p.user_id, p.ts, {r('p.amount')} as amount, case when epoch(date_trunc('second', p.ts)) - epoch(date_trunc('second', c.ts)) <= 2592000 then c.event_id end as click_id,
 {r("case when epoch(date_trunc('second', p.ts)) - epoch(date_trunc('second', c.ts)) <= 2592000 then c.value end")} as click_value from ({_PUR}) p
 left join lateral (select * from events c where c.event_type = 'click' and c.user_id = p.user_id and c.ts < p.ts order by c.ts desc, c.event_id desc limit 1) c on true"""
SQL["asof_at_or_before"] = """select p.event_id, p.user_id, p.ts, c.event_id as last_id from events p left join lateral (select * from events c where c.user_id = p.user_id and c.ts <= p.ts order by c.ts desc, c.event_id desc limit 1) c on true where p.event_type = 'error'"""
cte("ev", "select event_id, user_id, value, event_type, cast(ts as date) as day from events")
SQL["prior_days_events"] = f"""select a.event_id, a.user_id, {r('any_value(a.value)')} as value, a.day, count(case when p.day >= a.day - 7 then p.value end) as n_7, {r('avg(case when p.day >= a.day - 30 then p.value end)')} as avg_30, {r('max(p.value)')} as max_all, {r('stddev_samp(p.value)')} as sd_all
 from ev a left join ev p on p.user_id = a.user_id and p.day < a.day group by a.event_id, a.user_id, a.day"""
_W = "over (partition by user_id order by day, event_id rows between {} preceding and 1 preceding)"
SQL["prior_rows_events"] = f"""select event_id, user_id, {r('value')} as value, event_type, day, {r(f"avg(value) {_W.format(5)}")} as avg_5, {r(f"min(value) {_W.format(10)}")} as min_10, lag(event_type) over (partition by user_id order by day, event_id) as prev_type from ev"""
cte("evi", "select *, row_number() over (partition by user_id order by day, event_id) as i from ev")
SQL["decayed_events"] = f"""select a.event_id, a.user_id, {r('any_value(a.value)')} as value, a.day, {r('sum(p.value * exp(-0.2 * (a.i - p.i - 1))) / sum(exp(-0.2 * (a.i - p.i - 1)))')} as decayed_8 from evi a left join evi p on p.user_id = a.user_id and p.i < a.i and p.i >= a.i - 8 group by a.event_id, a.user_id, a.day"""
_U = "over (partition by user_id order by day, event_id rows between unbounded preceding and 1 preceding)"
SQL["running_events"] = f"""select event_id, user_id, event_type, day, count(*) {_U} as n, cast(coalesce(sum((event_type = 'error')::int) {_U}, 0) as bigint) as errors from ev"""
cte("evr", "select *, i - row_number() over (partition by user_id, event_type order by i) as run from evi")
cte("evs", "select *, count(*) over q as len, sum(value) over q as sv from evr window q as (partition by user_id, event_type, run order by i)")
SQL["streaks_events"] = f"""select event_id, user_id, event_type, {r('value')} as value, day, lag(event_type) over q as streak_state, lag(len) over q as streak_len, {r('lag(sv) over q')} as streak_value from evs window q as (partition by user_id order by i)"""
cte("gdays", "select distinct 'T' || home_team_id as team_abbrev, game_date from games")
SQL["latest_n_asof"] = """select team_abbrev, game_date, count(*) as n, max(injury_id) as newest, cast(sum((status = 'Out')::int) as bigint) as out from (select d.*, i.injury_id, i.status from gdays d join v_injuries i on i.team_abbrev = d.team_abbrev and i.capture_date <= d.game_date + 1
 qualify row_number() over (partition by d.team_abbrev, d.game_date order by i.capture_date desc, i.injury_id desc) <= 5) group by 1, 2"""
SQL["pair_rows"] = f"""select least(home_team_id, away_team_id) as lo_id, greatest(home_team_id, away_team_id) as hi_id, count(*) as games, cast(sum((winner_team_id = least(home_team_id, away_team_id))::int) as bigint) as lo_wins, cast(sum((winner_team_id = greatest(home_team_id, away_team_id))::int) as bigint) as hi_wins,
 {r('avg(case when home_team_id < away_team_id then home_score - away_score else away_score - home_score end)')} as lo_margin from played group by 1, 2"""
SQL["entity_rows"] = "select *, true as is_completed from tg"
SQL["feature_view"] = """select g.game_id, g.home_team_id as team_id, g.game_date, q.rolling_5_ppg, q.rolling_10_win_pct, q.rolling_10_net_rtg, q.wins_last_5 from games g left join lateral (select * from int_team_rolling_stats q where q.team_id = g.home_team_id and q.game_date <= g.game_date order by q.game_date desc, q.game_id desc limit 1) q on g.game_date - q.game_date <= 365"""

cte("wt", "select o_orderkey, o_orderstatus, o_totalprice, 0 as load_no from orders")
cte("wb1", "select case when o_orderkey % 3 = 0 then o_orderkey else -o_orderkey end as o_orderkey, o_orderstatus, o_totalprice + 1 as o_totalprice, 1 as load_no from orders")
cte("wb", "select * from wb1 union all select o_orderkey, 'X', o_totalprice, case when o_orderkey % 2 = 0 then 2 else 0 end from wb1")
cte("wbl", "select * from wb qualify row_number() over (partition by o_orderkey order by load_no desc) = 1")
SQL["wr_upsert"] = "select * from wt where o_orderkey not in (select o_orderkey from wb) union all select * from wbl"
SQL["wr_append_new"] = "select * from wt union all select * from wbl where o_orderkey not in (select o_orderkey from wt)"
SQL["wr_only_new_keys"] = "select distinct o_orderkey from wb where o_orderkey not in (select o_orderkey from wt)"
SQL["wr_patch"] = """select coalesce(t.o_orderkey, b.o_orderkey) as o_orderkey, coalesce(case when b.o_orderkey % 5 <> 0 then b.o_orderstatus end, t.o_orderstatus) as o_orderstatus, case when t.o_orderkey is null then b.o_totalprice else t.o_totalprice end as o_totalprice, case when t.o_orderkey is null then b.load_no else t.load_no end as load_no
 from wt t full join wbl b on b.o_orderkey = t.o_orderkey"""
SQL["wr_replace_keys"] = "select * from wt where o_orderkey not in (select o_orderkey from wb) union all select * from wb"
_IN = "game_date >= date '1996-01-01' and game_date < date '1997-01-01'"
SQL["wr_replace_interval"] = f"select game_id, game_date, home_score from games where not ({_IN}) union all select game_id, game_date, -1 from games where {_IN} and game_id % 2 = 0"
SQL["wr_activate"] = """select o.o_custkey, o.o_orderkey, o.o_totalprice, case when o.o_custkey % 3 <> 0 then o.o_orderkey = (first_value(o.o_orderkey) over (partition by o.o_custkey order by o.o_totalprice desc, o.o_orderkey desc)) else o.o_orderkey % 2 = 0 end as is_active from orders o"""


def _rule(name, kind, table, bad):
    return f"select '{name}' as rule, '{kind}' as kind, count(*) as rows, cast(coalesce(sum(({bad})::int), 0) as bigint) as violations from {table}"


def _uniq(name, table, cols):
    return f"select '{name}' as rule, 'unique' as kind, count(*) as rows, count(*) - count(distinct ({cols})) as violations from {table}"


SQL["dq_lineitem_rules"] = " union all ".join([
    _rule("ship_not_null", "not_null", "lineitem", "l_shipdate is null or l_orderkey is null"), _rule("discount_range", "range", "lineitem", "l_discount < 0 or l_discount > 0.08"),
    _rule("quantity_min", "range", "lineitem", "l_quantity < 3"), _rule("flag_values", "enum", "lineitem", "l_returnflag not in ('A', 'N')"),
    _uniq("line_key", "lineitem", "l_orderkey, l_linenumber"), _uniq("part_key", "lineitem", "l_partkey"),
    _rule("order_exists", "referential", "lineitem", "l_orderkey not in (select case when o_orderstatus = 'P' then -o_orderkey else o_orderkey end from orders)")])
SQL["dq_orders_rules"] = " union all ".join([
    _rule("priority_format", "format", "orders", "not regexp_matches(o_orderpriority, '^[1-3]-[A-Z]+')"), _rule("customer_exists", "referential", "orders", "o_custkey not in (select case when c_nationkey = 3 then -c_custkey else c_custkey end from customer)")])
SQL["dq_game_rules"] = " union all ".join([_rule("score_range", "range", "games", "coalesce(home_score < 85 or home_score > 135, false)"), _rule("winner_set", "not_null", "games", "winner_team_id is null"), _uniq("game_key", "games", "game_id")])
_P = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


def _prof(table):
    return " union all ".join(f"select count(*) as rows, '{c}' as column_name, count(*) - count({c}) as nulls, count(distinct {c}) as distinct_values, avg({c}) as mean, stddev_samp({c}) as stddev from {table}" for c in _P)


SQL["dq_profile"] = f"select rows, column_name, nulls, distinct_values, {r('mean')} as mean, {r('stddev')} as stddev from ({_prof('lineitem')})"
SQL["dq_histogram"] = f"""select b as bin, {r('any_value(lo + b * w)')} as bin_start, count(*) as n from (select lo, w, cast(least(floor((l_extendedprice - lo) / w), 9) as int) as b from lineitem, (select min(l_extendedprice) as lo, (max(l_extendedprice) - min(l_extendedprice)) / 10 as w from lineitem)) group by b"""
cte("later_lines", """select case when l_returnflag = 'R' then l_quantity * 1.5::double else l_quantity end as l_quantity, case when l_returnflag <> 'A' then l_discount end as l_discount,
 case when l_returnflag = 'N' then 1000::double else l_extendedprice end as l_extendedprice, l_linenumber from lineitem""")
cte("pn", _prof("lineitem"))
cte("pr", _prof("later_lines"))
cte("drift0", " union all ".join(f"select pn.column_name, '{m}' as metric, pn.{m}::double as before, pr.{m}::double as after from pn join pr using (column_name)" for m in ("mean", "nulls", "distinct_values")))
cte("drift1", "select *, case when before = 0 and after <> 0 then 100.0 when before = 0 then 0.0 else abs((after - before) * 100.0 / abs(before)) end as change_pct from drift0")
SQL["dq_drift"] = f"""select column_name, metric, {r('before')} as before, {r('after')} as after, {r('change_pct')} as change_pct, case when change_pct >= 30 then 'high' when change_pct >= 15 then 'medium' when change_pct >= 5 then 'low' else 'none' end as severity from drift1"""
cte("met", "select event_type, cast(ts as date) as day, cast(sum(cast(value as decimal(18,4))) as double) as total from events group by 1, 2")
cte("meth", """select a.event_type, a.day, a.total, count(p.total) as n, avg(p.total) as m, stddev_samp(p.total) as sd, quantile_cont(p.total, 0.25) as q1, quantile_cont(p.total, 0.75) as q3, median(p.total) as med, list(p.total order by p.day) filter (where p.total is not null) as xs
 from met a left join met p on p.event_type = a.event_type and p.day < a.day and p.day >= a.day - 30 group by 1, 2, 3""")
cte("meth2", "select *, list_median(list_transform(xs, lambda x: abs(x - med))) as mad, list_reduce(xs, lambda acc, x: 0.7 * acc + 0.3 * x) as ew from (select * from meth where n > 0) union all select *, null, null from meth where n = 0")
SQL["dq_anomalies"] = f"""select event_type, day, {r('total')} as total, n as history, n >= 5 and coalesce(abs(total - m) > 3 * sd, false) as control_limits, n >= 5 and coalesce(total < q1 - 1.5 * (q3 - q1) or total > q3 + 1.5 * (q3 - q1), false) as iqr,
 n >= 5 and coalesce(abs(total - med) > 3.5 * mad * 1.4826, false) as mad, n >= 5 and coalesce(abs(total - ew) > 3 * sd, false) as ewma from meth2"""
SQL["dq_freshness"] = f"""select count(*) as rows, max(ts) as newest, {r("trunc(date_diff('microsecond', max(ts), timestamp '2024-02-01 00:00:00') / 1000000.0) / 3600.0")} as age_hours, trunc(date_diff('microsecond', max(ts), timestamp '2024-02-01 00:00:00') / 1000000.0) / 3600.0 <= 24 as is_fresh, count(*) > 0 as is_available from events"""


def _long(one, cols):
    return " union all ".join(f"select '{c}' as metric, cast({c} as varchar) as value from ({one})" for c in cols)


SQL["dq_training_report"] = _long("""select min(p.game_date) as first_day, max(p.game_date) as last_day, count(*) as rows, count(*) filter (where p.game_date >= date '1996-10-01') as trainable_rows, 5 as columns,
 round(avg((d.home_rest_days = 0)::int), 6) as empty_share_home_rest_days, round(avg((i.home_injury_impact_score = 0)::int), 6) as empty_share_home_injury_impact_score, 0 as games_missing
 from played p join int_team_rest_days d on d.game_id = p.game_id join int_game_injury_features i on i.game_id = p.game_id""",
    ("first_day", "last_day", "rows", "trainable_rows", "columns", "empty_share_home_rest_days", "empty_share_home_injury_impact_score", "games_missing"))
SQL["dq_rows_per_year"] = "select year(game_date) as year, count(*) as rows from played group by 1"
SQL["dq_raw_load_report"] = _long("""select count(*) as games, min(game_date) as first_game, max(game_date) as last_game, (select count(*) from v_player_boxscores) as box_rows, (select count(*) from v_injuries) as injury_rows, (select count(distinct capture_date) from v_injuries) as capture_days,
 (select count(distinct b.game_id) from v_player_boxscores b join games g on g.game_id = b.game_id) as games_with_box from games""", ("games", "first_game", "last_game", "box_rows", "injury_rows", "capture_days", "games_with_box"))
cte("mat", """select i.*, (select max(p.player_id) from people p where upper(trim(p.player_name)) = upper(trim(i.player_name)) and (i.team_abbrev = 'UNK' or p.abbr = i.team_abbrev)) as pid from v_injuries i where i.status <> 'N/A'""")
cte("mat2", "select year(capture_date) // 10 * 10 as decade, player_name, max((pid is not null)::int) as m, max((pid in (select player_id from stars))::int) as s, count(*) as n from mat group by 1, 2")
SQL["dq_injury_matching"] = f"""select cast(decade as int) as decade, cast(sum(n) as bigint) as reports, count(*) as names, cast(sum(m) as bigint) as matched_names, cast(coalesce(sum(s), 0) as bigint) as star_names, {r('sum(m) / count(*)')} as matched_share, {r('coalesce(sum(s), 0) / count(*)')} as star_share from mat2 group by 1"""
SQL["dq_date_alignment"] = """select year(d) as year, count(g) as game_days, count(i) as report_days, count(*) filter (where g is not null and i is not null) as both from (select coalesce(a.d, b.d) as d, a.d as g, b.d as i from (select distinct game_date as d from games) a full join (select distinct capture_date as d from v_injuries) b on a.d = b.d) group by 1"""
cte("firstrep", "select team_id, min(capture_date) as f from reports group by 1")
SQL["dq_fallback"] = """select count(*) as games, count(*) filter (where x) as games_with_impact, count(*) filter (where x and not b) as from_fallback from (select i.home_injury_impact_score > 0 or i.away_injury_impact_score > 0 as x, coalesce(h.f <= g.game_date + 1, false) or coalesce(a.f <= g.game_date + 1, false) as b
 from played g join int_game_injury_features i on i.game_id = g.game_id left join firstrep h on h.team_id = g.home_team_id left join firstrep a on a.team_id = g.away_team_id)"""

SQL["in_interval_run"] = f"select * from ({MODELS['int_team_streaks']}) where game_date >= date '1997-01-01' and game_date < date '1998-01-01'"
SQL["in_backfill"] = f"select * from ({MODELS['int_team_clutch_perf']}) where game_date >= date '1995-01-01' and game_date < date '1998-01-01'"
SQL["in_backfill_reads"] = """
select make_date(y, 1, 1) as chunk_start, make_date(y + 1, 1, 1) as chunk_end,
       (select count(*) from games where game_date < make_date(y + 1, 1, 1) and (y = 1995 or game_date >= make_date(y, 1, 1))) as game_rows,
       case when y = 1995 then 0 else (select count(*) from (select distinct team_id, yr from (
           select home_team_id as team_id, year(game_date) as yr, game_date from games where home_score is not null and away_score is not null
           union all select away_team_id, year(game_date), game_date from games where home_score is not null and away_score is not null)
         where game_date < make_date(y, 1, 1))) end as state_rows
from (select unnest([1995, 1996, 1997, 1998]) as y)
"""
_D = """select (select count(*) from games where game_id % 13 = 0) as added, count(*) filter (where game_id % 11 = 0) as removed, count(*) filter (where game_id % 11 <> 0) as shared, count(*) filter (where game_id % 11 <> 0 and game_id % 5 = 0) as ch from games"""
SQL["in_table_diff"] = f"select c as column_name, added, removed, shared, case when c = 'home_score' then ch else 0 end as changed from ({_D}), (values ('game_date'), ('home_score'), ('away_score')) t(c)"
SQL["in_coverage"] = f"select min(game_date) as first_day, max(game_date) as last_day, count(*) as rows, count(distinct year(game_date)) as years, {r('count(distinct year(game_date)) / 15.0')} as share_of_years from games"
SQL["in_best_version"] = """select *, row_number() over (order by filled desc, version) as rank from (select count(*) filter (where home_rest_days <> 0) as filled, count(*) as rows, 'full' as version from int_team_rest_days
 union all select count(*) filter (where home_rest_days <> 0), count(*), 'even' from int_team_rest_days where game_id % 2 = 0 union all select 0, count(*), 'zeroed' from int_team_rest_days)"""
