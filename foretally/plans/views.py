"""Game-shaped inputs derived from the star-schema test tables.

The SQL text runs unchanged on Spark and on DuckDB; `{orders}`-style names stand
for the base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = ("orders", "lineitem", "events", "nation", "region")

VIEWS = {
    "v_games": """
select o_orderkey as game_id, cast(o_orderdate as date) as game_date, cast(year(o_orderdate) as string) as season,
 cast(o_custkey % 25 as int) as home_team_id, cast((o_custkey + 1 + (o_orderkey % 24)) % 25 as int) as away_team_id,
 case when o_orderkey % 50 <> 0 then cast(cast(floor(o_totalprice) as bigint) % 60 + 80 as int) end as home_score,
 case when o_orderkey % 50 <> 0 then cast(cast(floor(o_totalprice / 7) as bigint) % 60 + 80 as int) end as away_score,
 case when o_orderkey % 17 = 0 then 'Final/OT' else 'Final' end as game_status from {orders}""",
    "v_team_boxscores": """
select game_id, game_date, team_id, is_home, points,
 cast(15 + (game_id * 7 + team_id) % 21 as int) as assists, cast(30 + (game_id * 5 + team_id) % 25 as int) as rebounds,
 cast((game_id * 11 + team_id) % 12 as int) as steals, cast((game_id * 13 + team_id) % 9 as int) as blocks,
 cast(70 + (game_id + team_id) % 30 as int) as fg_attempted,
 cast(30 + (game_id + team_id) % 17 as int) as fg_made, cast((game_id + team_id) % 13 as int) as fg3_made,
 cast(13 + (game_id + team_id) % 20 as int) as fg3_attempted,
 cast(10 + (game_id + team_id) % 20 as int) as ft_attempted, cast(5 + (game_id + team_id) % 6 as int) as ft_made,
 cast(5 + (game_id * 3 + team_id) % 15 as int) as turnovers,
 cast((30 + (game_id + team_id) % 17) as double) / (70 + (game_id + team_id) % 30) as fg_pct,
 cast(((game_id + team_id) % 13) as double) / (13 + (game_id + team_id) % 20) as fg3_pct,
 cast(floor(points / 4) as int) + cast((game_id + team_id) % 9 as int) as q4_points
 from (select game_id, game_date, home_team_id as team_id, true as is_home, home_score as points from {v_games}
  union all select game_id, game_date, away_team_id, false, away_score from {v_games}) t where points is not null""",
    "v_player_boxscores": """
select g.game_id, g.game_date, t.team_id * 15 + cast(l.l_partkey % 15 as int) as player_id, t.team_id, t.is_home,
 max(cast(floor(l.l_quantity * (1 + l.l_partkey % 15) / 15) as int)) as points, max(cast(floor(l.l_discount * 100) as int)) as assists, max(l.l_linenumber) as rebounds,
 max(case when l.l_returnflag = 'R' then '0:00' else concat('PT', cast(10 + l.l_linenumber as string), 'M30S') end) as minutes
 from {lineitem} l join {v_games} g on g.game_id = l.l_orderkey
 join {v_team_boxscores} t on t.game_id = g.game_id and t.is_home = (l.l_linenumber % 2 = 1)
 group by g.game_id, g.game_date, t.team_id * 15 + cast(l.l_partkey % 15 as int), t.team_id, t.is_home""",
    "v_injuries": """
select event_id as injury_id, date '1995-01-01' + cast(event_id % 2400 as int) as capture_date,
 concat('Player ', cast(user_id * 7 % 375 as string)) as player_name,
 case when event_id % 11 = 0 then 'UNK' else concat('T', cast(cast(floor((user_id * 7 % 375) / 15) as int) as string)) end as team_abbrev,
 case event_type when 'error' then 'Out' when 'purchase' then 'Questionable' when 'signup' then 'Doubtful' when 'click' then 'Probable' else 'N/A' end as status
 from {events}""",
    "v_teams": """
select cast(n_nationkey as int) as team_id, n_name as team_name, concat('T', cast(n_nationkey as string)) as team_abbreviation,
 r_name as conference, case when n_nationkey % 2 = 0 then 'East' else 'West' end as division
 from {nation} join {region} on r_regionkey = n_regionkey""",
}


def base_tables(spark: SparkSession, sf_dir: str, names=BASE) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def staging_from_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Staging frames (and the raw quarter points) over the test tables."""
    frames = base_tables(spark, sf_dir)
    for name, sql in VIEWS.items():
        used = {k: v for k, v in frames.items() if "{" + k + "}" in sql}
        frames[name] = spark.sql(sql, **used)
    g = frames["v_games"]
    winner = F.when(F.col("home_score") > F.col("away_score"), F.col("home_team_id")).when(
        F.col("away_score") > F.col("home_score"), F.col("away_team_id"))
    done = F.col("home_score").isNotNull() & F.col("away_score").isNotNull()
    games = g.select("*", winner.alias("winner_team_id"), F.col("game_status").like("%OT%").alias("is_overtime"), done.alias("is_completed"))
    players = frames["v_player_boxscores"]
    from ..functions.text import minutes_played

    people = players.select("player_id", "team_id").distinct().select(
        "player_id", F.concat(F.lit("Player "), F.col("player_id").cast("string")).alias("player_name"), "team_id",
        F.concat(F.lit("T"), F.col("team_id").cast("string")).alias("team_abbreviation"))
    injuries = frames["v_injuries"].select(
        "*", F.col("status").alias("status_raw"), F.lit(None).cast("string").alias("injury_details"))
    return {
        "stg_games": games,
        "stg_team_boxscores": frames["v_team_boxscores"],
        "raw_team_boxscores": frames["v_team_boxscores"].select("game_id", "team_id", "game_date", "is_home", "q4_points"),
        "stg_player_boxscores": players.withColumn("minutes_played", minutes_played("minutes")),
        "players": people,
        "stg_injuries": injuries,
        "stg_teams": frames["v_teams"],
    }
