"""Table contracts: column types, nullability, keys; strict projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Contract type -> Spark type.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "integer": T.LongType(), "float": T.DoubleType(), "decimal": T.DecimalType(38, 9),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "datetime": T.TimestampType(),
    "time": T.StringType(), "json": T.StringType(), "array": T.ArrayType(T.StringType()),
    "object": T.MapType(T.StringType(), T.StringType()),
}


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    unique: tuple[str, ...] = field(default=())


def from_mapping(spec: dict) -> Contract:
    """Contract from a parsed YAML mapping: name and columns with type, nullable, primary_key, unique."""
    cols = spec.get("columns") or spec.get("schema", {}).get("columns", [])
    fields, key, unique = [], [], []
    for c in cols:
        kind = str(c.get("type", "string")).lower()
        is_key = bool(c.get("primary_key", False))
        fields.append(T.StructField(c["name"], TYPES.get(kind, T.StringType()), bool(c.get("nullable", True)) and not is_key))
        if is_key:
            key.append(c["name"])
        if c.get("unique", False):
            unique.append(c["name"])
    return Contract(spec["name"], T.StructType(fields), tuple(key), tuple(unique))


def from_yaml(text: str) -> Contract:
    try:
        import yaml
    except ImportError as e:  # optional dependency
        raise RuntimeError("reading contract files needs PyYAML; use from_mapping instead") from e
    return from_mapping(yaml.safe_load(text))


def from_text(name: str, key: str, columns: str) -> Contract:
    """Contract from `column type!` pairs; `!` means not null."""
    cols = [c.strip().rstrip("!").split() + [c.strip().endswith("!")] for c in columns.replace("\n", " ").split(",")]
    fields = [T.StructField(n, TYPES[t], not required) for n, t, required in cols]
    return Contract(name, T.StructType(fields), tuple(key.split()))


_STATS = """points integer, assists integer, rebounds_total integer"""
_SHOTS = """field_goals_made integer, field_goals_attempted integer, field_goal_pct float, three_pointers_made integer,
 three_pointers_attempted integer, three_point_pct float, free_throws_made integer, free_throws_attempted integer, free_throw_pct float"""

# The raw tables the ingestion jobs fill.
CONTRACTS = {
    c.name: c
    for c in (
        from_text("teams", "team_id", """team_id integer!, team_name string!, team_abbreviation string!, city string!, conference string!,
 division string!, is_active boolean!, created_at timestamp!"""),
        from_text("games", "game_id", """game_id string!, game_date string, season string!, season_type string!, home_team_id integer,
 away_team_id integer, home_team_name string, away_team_name string, home_score integer, away_score integer, winner_team_id integer,
 game_status string, venue string, arena_city string, arena_state string, created_at timestamp!"""),
        from_text("todays_games", "game_id", """game_id string!, game_date string, season string!, season_type string!, home_team_id integer,
 away_team_id integer, home_team_name string, away_team_name string, home_score integer, away_score integer, winner_team_id integer,
 game_status string, period integer, game_clock string, created_at timestamp!"""),
        from_text("players", "player_id", """player_id integer!, first_name string, last_name string, player_name string!, player_slug string,
 team_id integer, team_name string, team_city string, team_abbreviation string, jersey_number string, position string, height string,
 weight integer, college string, country string, draft_year integer, draft_round integer, draft_number integer, from_year integer,
 to_year integer, career_pts float, career_reb float, career_ast float, created_at timestamp!"""),
        from_text("betting_odds", "game_id book_name market_type", """game_id string!, book_name string!, market_type string!, home_odds float,
 away_odds float, home_line float, away_line float, over_odds float, under_odds float, total_line float, captured_at timestamp!"""),
        from_text("boxscores", "game_id player_id", f"""game_id string!, player_id integer!, game_date string, player_name string, team_id integer,
 is_home boolean, is_starter boolean, minutes string, minutes_calculated string, {_STATS}, rebounds_offensive integer,
 rebounds_defensive integer, steals integer, blocks integer, turnovers integer, fouls_personal integer, fouls_technical integer, {_SHOTS},
 plus_minus integer, points_fast_break integer, points_in_paint integer, points_second_chance integer, created_at timestamp!"""),
        from_text("team_boxscores", "game_id team_id", f"""game_id string!, team_id integer!, game_date string, team_name string, team_city string,
 is_home boolean, {_STATS}, steals integer, blocks integer, turnovers integer, {_SHOTS}, q1_points integer, q2_points integer,
 q3_points integer, q4_points integer, created_at timestamp!"""),
        from_text("injuries", "injury_id", """injury_id string!, capture_date date!, player_name string!, player_espn_id string, team_name string!,
 team_abbrev string!, status string!, status_raw string, injury_details string, captured_at timestamp!"""),
    )
}


def conform(df: DataFrame, contract: Contract, strict: bool = True) -> DataFrame:
    """Cast to the contract types; missing columns become NULL, extra ones go when strict.

    A value that does not fit its type becomes NULL, which the not-null rule then reports.
    """
    have = set(df.columns)
    cols = [
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in contract.schema.fields
    ]
    extra = [] if strict else [F.col(c) for c in df.columns if c not in contract.schema.names]
    return df.select(*cols, *extra)


def null_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per required column with the number of NULLs found."""
    req = [f.name for f in contract.schema.fields if not f.nullable]
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in req])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in req])).alias("r")).select("r.*")
