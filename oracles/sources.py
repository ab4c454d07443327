"""Check queries of the ingestion jobs: what the payload was built from."""

from __future__ import annotations

from .models import CTES  # noqa: F401
from .sql import cte, h, r

SQL: dict[str, str] = {}

_LABEL = "case when month({d}) >= 10 then year({d}) || '-' || lpad(cast((year({d}) + 1) % 100 as varchar), 2, '0') else (year({d}) - 1) || '-' || lpad(cast(year({d}) % 100 as varchar), 2, '0') end"
_G = f"""cast(game_id as varchar) as game_id, cast(game_date as varchar) as game_date, {_LABEL.format(d='game_date')} as season, 'Regular Season' as season_type, home_team_id, away_team_id,
 'City' || home_team_id || ' Name' || home_team_id as home_team_name, 'City' || away_team_id || ' Name' || away_team_id as away_team_name, home_score, away_score, winner_team_id, game_status"""
cte("raw_games", f"select {_G}, 'Arena' as venue, cast(null as varchar) as arena_city, cast(null as varchar) as arena_state from games")
SQL["src_games"] = "select * from raw_games"
SQL["src_csv_round_trip"] = "select * from raw_games"
cte("raw_teams", """select t.team_id, 'Name' || t.team_id as team_name, 'T' || t.team_id as team_abbreviation, 'City' || t.team_id as city, conference, division, true as is_active
 from v_teams t where t.team_id in (select home_team_id from games) or t.team_id in (select away_team_id from games)""")
SQL["src_teams"] = "select * from raw_teams"
SQL["src_todays_games"] = f"select {_G}, 4 as period, '' as game_clock from games"
_NULLS = ", ".join(f"null as {c}" for c in ("player_slug", "team_name", "team_city", "jersey_number", "position", "height", "weight", "college", "country", "draft_year", "draft_round", "draft_number", "from_year", "to_year", "career_reb", "career_ast"))
SQL["src_players"] = f"select distinct player_id, 'Player' as first_name, cast(player_id as varchar) as last_name, 'Player ' || player_id as player_name, team_id, 'T' || team_id as team_abbreviation, player_id * 1.5::double as career_pts, {_NULLS} from v_player_boxscores where player_id % 3 = 1"
SQL["src_betting_odds"] = """select cast(game_id as varchar) as game_id, b as book_name, '2way' as market_type, 1 + game_id % 7 * 0.25::double as home_odds, 1 + game_id % 5 * 0.5::double as away_odds, game_id % 9 - 4.5::double as home_line, 4.5::double - game_id % 9 as away_line,
 null as over_odds, null as under_odds, null as total_line from v_games, (values ('BookA'), ('BookB')) t(b)
 union all select cast(game_id as varchar), b, 'total', null, null, null, null, 1 + game_id % 4 * 0.25::double, 1 + game_id % 3 * 0.5::double, cast(game_id % 30 + 200 as double) from v_games, (values ('BookA'), ('BookB')) t(b)"""
_Z = ("rebounds_offensive", "rebounds_defensive", "steals", "blocks", "turnovers", "fouls_personal", "fouls_technical", "three_pointers_made", "three_pointers_attempted",
      "free_throws_made", "free_throws_attempted", "plus_minus", "points_fast_break", "points_in_paint", "points_second_chance")
cte("raw_box", f"""select cast(game_id as varchar) as game_id, player_id, cast(game_date as varchar) as game_date, 'Player ' || player_id as player_name, team_id, is_home, player_id % 3 = 0 as is_starter, minutes, '0:00' as minutes_calculated,
 points, assists, rebounds as rebounds_total, points // 3 as field_goals_made, points // 3 + assists as field_goals_attempted, {', '.join(f'0 as {c}' for c in _Z)},
 0.0::double as field_goal_pct, 0.0::double as three_point_pct, 0.0::double as free_throw_pct from v_player_boxscores""")
SQL["src_boxscores"] = "select * from raw_box"
cte("raw_team_box", f"""select game_id, team_id, any_value(game_date) as game_date, 'Name' || team_id as team_name, cast(null as varchar) as team_city, is_home, cast(sum(points) as bigint) as points, cast(sum(assists) as bigint) as assists, cast(sum(rebounds_total) as bigint) as rebounds_total,
 0 as steals, 0 as blocks, 0 as turnovers, cast(sum(field_goals_made) as bigint) as field_goals_made, cast(sum(field_goals_attempted) as bigint) as field_goals_attempted,
 coalesce({h('100.0 * sum(field_goals_made) / nullif(sum(field_goals_attempted), 0)', 1)}, 0.0) as field_goal_pct, 0 as three_pointers_made, 0 as three_pointers_attempted, 0.0::double as three_point_pct, 0 as free_throws_made, 0 as free_throws_attempted, 0.0::double as free_throw_pct,
 team_id + 10 as q1_points, team_id + 20 as q2_points, team_id + 30 as q3_points, team_id + 40 as q4_points from raw_box group by game_id, team_id, is_home""")
SQL["src_team_boxscores"] = "select * from raw_team_box"
cte("rep0", "select injury_id, capture_date, player_name, team_abbrev, status, 'Team ' || substr(team_abbrev, 2, 3) as team_name from v_injuries")


def _team_page(day: str) -> str:
    return f"""select {day} || '_' || case when team_abbrev = 'UNK' then 'UNK' else team_abbrev end || '_' || replace(player_name, ' ', '_') as injury_id, cast({day} as date) as capture_date, player_name, cast(injury_id as varchar) as player_espn_id, team_name,
 team_abbrev, status, status as status_raw, 'knee & ankle ' || injury_id as injury_details from rep0"""


SQL["src_injuries_by_team"] = _team_page("cast(capture_date as varchar)")
SQL["src_injuries_past_day"] = _team_page("'2001-02-03'")
SQL["src_injuries_by_row"] = """select cast(capture_date as varchar) || '_' || team_abbrev || '_' || replace(player_name, ' ', '_') as injury_id, capture_date, player_name, cast(null as varchar) as player_espn_id,
 case when team_abbrev = 'UNK' then 'Unknown' else team_name end as team_name, team_abbrev, case when status = 'N/A' then 'Unknown' else status end as status, case when status = 'N/A' then 'Unknown' else status end as status_raw, 'knee injury no ' || injury_id as injury_details from rep0"""
SQL["src_page_tables"] = "select date '2024-01-01' + cast(page_id % 365 as int) as capture_date, 'N/A' as team_abbrev, 'N/A' as status, count(*) as n from pages group by 1"
SQL["src_history_boxscores"] = """select cast(game_id as varchar) as game_id, case when player_id % 2 = 0 then player_id else cast(concat('0x', substr(md5('Player ' || player_id), 1, 8)) as bigint) % 1000000000 end as player_id, cast(game_date as varchar) as game_date, 'Player ' || player_id as player_name, team_id, is_home,
 row_number() over (partition by game_id, team_id order by player_id) <= 5 as is_starter, '3' || player_id % 10 || ':30' as minutes, cast((30 + player_id % 10) * 60 + 30 as varchar) || ':00' as minutes_calculated, points, assists, rebounds as rebounds_total, 0 as steals from v_player_boxscores"""
SQL["src_synthetic_ids"] = """select game_id, '002' || lpad(cast((case when month(game_date) >= 10 then year(game_date) else year(game_date) - 1 end) % 100 as varchar), 2, '0') || strftime(game_date, '%m%d') || '0' || lpad(cast(game_id % 100 as varchar), 2, '0') as synthetic_id,
 case when game_id % 2 = 0 then 1610612738 end as mapped_team_id from games"""
SQL["src_bulk_player_stats"] = """select cast(game_id as varchar) as game_id, player_id, cast(game_date + 1 as varchar) as game_date, 'Player ' || player_id as player_name, team_id, is_home, case when minutes like 'PT%' then cast(substr(minutes, 3, 2) as int) + 0.5 else 0.0 end || '' as minutes,
 case when minutes like 'PT%' then minutes end as minutes_calculated, points, assists, rebounds as rebounds_total, null as steals from v_player_boxscores"""
cte("tx", """select capture_date, team_name, case when injury_id % 4 in (0, 2) then player_name end as acq, case when injury_id % 4 in (1, 2) then player_name || ' Jr' end as rel, team_abbrev,
 coalesce(case injury_id % 5 when 0 then 'placed on IL' when 1 then 'questionable, may be out' when 2 then 'Doubtful' end, '') as notes from rep0 where injury_id % 13 <> 0""")
_ST1 = "case when lower(notes) like '%out%' or lower(notes) like '%placed on%' then 'Out' when lower(notes) like '%doubtful%' then 'Doubtful' when lower(notes) like '%questionable%' then 'Questionable' else 'Out' end"
_ST2 = "case when lower(notes) like '%doubtful%' then 'Doubtful' when lower(notes) like '%questionable%' then 'Questionable' else 'Out' end"
SQL["src_transactions"] = f"""select cast(capture_date as varchar) || '_' || team_name || '_' || replace(rel, ' ', '_') as injury_id, capture_date, rel as player_name, team_name, team_abbrev, {_ST1} as status, {_ST1} as status_raw, notes as injury_details from tx where rel is not null
 union all select cast(capture_date as varchar) || '_' || team_name || '_' || replace(acq, ' ', '_') || '_return', capture_date, acq, team_name, team_abbrev, 'Active', 'Active', 'Returned from injury: ' || notes from tx where acq is not null"""
SQL["src_transactions_recent"] = f"""select cast(capture_date as varchar) || '_' || team_abbrev || '_' || replace(rel, ' ', '_') || '_OUT' as injury_id, capture_date, rel as player_name, team_name, team_abbrev, {_ST2} as status, notes as status_raw, notes as injury_details from tx where rel is not null
 union all select cast(capture_date as varchar) || '_' || team_abbrev || '_' || replace(acq, ' ', '_') || '_ACTIVE', capture_date, acq, team_name, team_abbrev, 'Active', 'Returned from injury list', notes from tx where acq is not null"""
SQL["src_mapped_csv"] = """select cast(game_id as varchar) as game_id, cast(game_date as varchar) as game_date, season, 'Regular Season' as season_type, home_team_id, away_team_id, null as home_team_name, null as away_team_name, home_score, away_score, null as winner_team_id, 'Final' as game_status,
 null as venue, null as arena_city, null as arena_state from games"""
SQL["src_games_from_boxscores"] = f"""select * from (select game_id, game_date, {_LABEL.format(d='game_date')} as season, 'Regular Season' as season_type, max(case when is_home then team_id end) as home_team_id, max(case when not is_home then team_id end) as away_team_id, cast(sum(case when is_home then points else 0 end) as int) as home_score, cast(sum(case when not is_home then points else 0 end) as int) as away_score,
 case when sum(case when is_home then points else 0 end) > sum(case when not is_home then points else 0 end) then max(case when is_home then team_id end) else max(case when not is_home then team_id end) end as winner_team_id
 from v_player_boxscores where game_id % 3 <> 0 group by game_id, game_date) where home_team_id is not null and away_team_id is not null"""
SQL["src_team_boxscores_from_players"] = f"""select game_id, game_date, team_id, is_home, cast(sum(points) as int) as points, cast(sum(assists) as int) as assists, cast(sum(rebounds) as int) as rebounds_total, cast(sum(points // 3) as int) as field_goals_made, cast(sum(points // 3 + assists) as int) as field_goals_attempted,
 {r('coalesce(sum(points // 3) / nullif(sum(points // 3 + assists), 0), 0.0)')} as field_goal_pct from v_player_boxscores where (game_id + team_id) % 3 <> 0 group by 1, 2, 3, 4"""
SQL["src_contract_nulls"] = """select 'game_id' as column_name, 0 as violations union all select 'season', 0 union all select 'season_type', count(*) from games where game_id % 10 = 0 union all select 'created_at', 0"""
SQL["stg_games"] = """select game_id, game_status, cast(game_date as date) as game_date, season, season_type, home_team_id, home_team_name, away_team_id, away_team_name, home_score, away_score, venue as arena_name, arena_city, arena_state, winner_team_id,
 game_status like '%OT%' as is_overtime, game_status in ('Final', 'Final/OT', 'Final/OT2') or (home_score is not null and away_score is not null) as is_completed from raw_games"""
SQL["stg_player_boxscores"] = f"""select game_id, player_id, cast(game_date as date) as game_date, player_name, team_id, is_home, is_starter, {r("case when minutes like 'PT%' then cast(regexp_extract(minutes, 'PT([0-9]+)M', 1) as double) + cast(regexp_extract(minutes, 'M([0-9]+)S', 1) as double) / 60 else 0.0 end")} as minutes_played,
 points, assists, rebounds_total as rebounds, field_goals_made as fg_made, field_goals_attempted as fg_attempted, plus_minus, points_fast_break as points_fastbreak from raw_box"""
SQL["stg_team_boxscores"] = """select game_id, team_id, cast(game_date as date) as game_date, team_name, team_city, is_home, points, assists, rebounds_total as rebounds, steals, blocks, turnovers, field_goals_made as fg_made, field_goals_attempted as fg_attempted,
 three_pointers_made as fg3_made, three_pointers_attempted as fg3_attempted, free_throws_made as ft_made, free_throws_attempted as ft_attempted, field_goal_pct as fg_pct, three_point_pct as fg3_pct, free_throw_pct as ft_pct from raw_team_box"""
SQL["stg_injuries"] = SQL["src_injuries_by_team"]
SQL["stg_teams"] = "select team_id, team_name, team_abbreviation, city as team_city, conference, division from raw_teams"
