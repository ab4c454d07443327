"""Earlier meetings of the same two entities, whoever was at home."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_pair(games: DataFrame) -> DataFrame:
    """Add the unordered pair key and the game seen from the lower-id entity.

    `lo_sign` is 1 when the lower id is at home; multiply a lower-side value by
    it to see it from the home side.
    """
    lo_home = F.col("home_team_id") < F.col("away_team_id")
    margin = F.col("home_score") - F.col("away_score")
    lo = F.least("home_team_id", "away_team_id")
    hi = F.greatest("home_team_id", "away_team_id")
    return games.select(
        "*",
        lo.alias("lo_id"),
        hi.alias("hi_id"),
        lo_home.alias("lo_home"),
        F.when(lo_home, margin).otherwise(-margin).alias("lo_margin"),
        F.when(F.col("winner_team_id") == lo, 1).otherwise(0).alias("lo_win"),
        F.when(F.col("winner_team_id") == hi, 1).otherwise(0).alias("hi_win"),
    )
