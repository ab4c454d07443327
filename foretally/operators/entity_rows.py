"""Games to one row per (game, team), and back to one row per game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_entity_rows(games: DataFrame) -> DataFrame:
    """One scan, two rows per game: the home side and the away side.

    `is_win` is 1 only for the winner, so a tie or an unplayed game gives 0 on
    both sides; `margin` is signed from the side's own view.
    """

    def side(me: str, other: str, home: bool) -> Column:
        return F.struct(
            F.col(f"{me}_team_id").alias("team_id"),
            F.col(f"{other}_team_id").alias("opp_id"),
            F.lit(home).alias("is_home"),
            F.col(f"{me}_score").alias("pts"),
            F.col(f"{other}_score").alias("opp_pts"),
        )

    base = games.select(
        "game_id", "game_date", "season", "winner_team_id", "is_overtime", "is_completed",
        F.explode(F.array(side("home", "away", True), side("away", "home", False))).alias("s"),
    )
    return base.select("game_id", "game_date", "season", "winner_team_id", "is_overtime", "is_completed", "s.*").select(
        "*",
        F.when(F.col("winner_team_id") == F.col("team_id"), 1).otherwise(0).alias("is_win"),
        (F.col("pts") - F.col("opp_pts")).alias("margin"),
        F.year("game_date").alias("yr"),
    )


def to_game_rows(
    games: DataFrame,
    sides: DataFrame,
    defaults: dict[str, object],
    diffs: dict[str, str] | None = None,
    keep: tuple[str, ...] = ("game_id", "game_date", "home_team_id", "away_team_id"),
) -> DataFrame:
    """Turn (game_id, is_home, features...) into home_* / away_* columns per game.

    A game with no side row keeps the default of each feature. `diffs` maps an
    output name to the feature whose home minus away value it holds.
    """
    marks = (("home", "is_home"), ("away", "not is_home"))
    # Expression text keeps wide projections cheap to build.
    pivoted = sides.groupBy("game_id").agg(
        *[F.expr(f"max(case when {mark} then `{c}` end) as `{side}_{c}`") for side, mark in marks for c in defaults])
    out = games.select(*dict.fromkeys(keep)).join(pivoted, "game_id", "left")
    names = {f"{side}_{c}": filled(f"{side}_{c}", d) for side in ("home", "away") for c, d in defaults.items()}
    more = {n: f"{names[f'home_{c}']} - {names[f'away_{c}']}" for n, c in (diffs or {}).items()}
    return out.selectExpr(*keep, *[f"{e} as `{n}`" for n, e in {**names, **more}.items()])


def filled(column: str, default) -> str:
    """Expression text of a column with its default."""
    if default is None:
        return f"`{column}`"
    text = f"{default!r}D" if isinstance(default, float) else str(default).lower()
    return f"coalesce(`{column}`, {text})"
