"""Star players, their returns, and injuries per game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import flag, nvl
from ..functions.text import name_key
from ..operators.asof import latest_n_asof
from ..operators.history import attach, prior_rows
from ..operators.scratch import kept
from .registry import Models, model, with_updated_at


@model("player_appearances", table=True)
def player_appearances(m: Models) -> DataFrame:
    """Box-score rows of players who were on court in a finished game; written once, three models read it."""
    done = m.games.filter("is_completed").select("game_id", "game_date")
    return m["stg_player_boxscores"].filter("minutes_played > 0").drop("game_date").join(done, "game_id").select(
        "game_id", "game_date", "team_id", "player_id", "points", "assists", "rebounds")


def _appearances(m: Models) -> DataFrame:
    return m["player_appearances"]


@model("int_star_players", table=True, whole=True)
def star_players(m: Models) -> DataFrame:
    # A player has one row per game, so counting rows per (player, game) first keeps the distinct count exact and cheap.
    per_game = _appearances(m).groupBy("player_id", "team_id", "game_id").agg(
        *[F.sum(c).alias(c) for c in ("points", "assists", "rebounds")], F.count(F.lit(1)).alias("n"))
    s = per_game.groupBy("player_id", "team_id").agg(
        F.count(F.lit(1)).alias("games"),
        *[(F.sum(c).cast("double") / F.sum("n")).alias(a) for c, a in (("points", "avg_ppg"), ("assists", "avg_apg"), ("rebounds", "avg_rpg"))])
    s = s.filter((F.col("games") >= 10) & (F.col("avg_ppg") >= 15))
    return s.select(
        "player_id", "team_id", "avg_ppg", "avg_apg", "avg_rpg",
        F.when(F.col("avg_ppg") >= 20, "star").otherwise("key_player").alias("player_tier"),
        (F.col("avg_ppg") + F.col("avg_apg") * 0.5 + F.col("avg_rpg") * 0.3).alias("impact_score"),
    )


# Weight of a return by tier, after 14 and after 7 days.
RETURN_WEIGHTS = {"star": (1.5, 1.2), "key_player": (1.3, 1.1)}


@model("int_star_player_avail")
def star_availability(m: Models) -> DataFrame:
    stars = m["int_star_players"].select("player_id", "team_id", "player_tier", "impact_score")
    rows = _appearances(m).select("game_id", "game_date", "team_id", "player_id").join(stars, ["player_id", "team_id"])
    rows = prior_rows(rows, ["player_id", "team_id"], "game_date", ["game_id"], depth=1,
                      exprs=lambda w: {"prev_game_date": F.lag("game_date").over(w(None, None))})
    gap = F.datediff("game_date", "prev_game_date")
    weight = F.lit(None).cast("double")
    for tier, (long, short) in RETURN_WEIGHTS.items():
        weight = F.when(F.col("player_tier") == tier, F.when(gap >= 14, long).when(gap >= 7, short)).otherwise(weight)
    return rows.select(
        "game_id", "game_date", "team_id", "player_id", "player_tier", "impact_score", "prev_game_date",
        gap.alias("days_since_last_game"), flag(gap >= 7).alias("is_return_game"), flag(gap >= 14).alias("is_extended_return_game"),
        F.coalesce(F.col("impact_score") * weight, F.lit(0.0)).alias("return_impact_score"),
    )


@model("int_team_star_feats")
def star_features(m: Models) -> DataFrame:
    back, long = F.col("is_return_game") == 1, F.col("is_extended_return_game") == 1
    tier, days = F.col("player_tier"), F.col("days_since_last_game")
    g = m["int_star_player_avail"].groupBy("game_id", "game_date", "team_id").agg(
        F.sum(flag(back & (tier == "star"))).alias("star_players_returning"),
        F.sum(flag(back & (tier == "key_player"))).alias("key_players_returning"),
        F.sum(flag(long)).alias("extended_returns"), F.sum("return_impact_score").alias("total_return_impact"),
        F.max(F.when(back, days)).alias("max_days_since_return"), F.avg(F.when(back, days)).alias("avg_days_since_return"),
        F.countDistinct(F.when(tier == "star", F.col("player_id"))).alias("star_players_playing"),
        F.countDistinct(F.when(tier == "key_player", F.col("player_id"))).alias("key_players_playing"),
    )
    return g.select("*", flag((F.col("star_players_returning") > 0) | (F.col("extended_returns") > 0)).alias("has_star_return"),
                    flag(F.col("extended_returns") > 0).alias("has_extended_return"))


# Status words by priority.
STATUS_WORDS = {"OUT": "Out", "DOUBTFUL": "Doubtful", "QUESTIONABLE": "Questionable", "PROBABLE": "Probable"}
# Weight of an absence by status and tier.
ABSENCE_WEIGHTS = {("Out", "star"): 1.0, ("Out", "key_player"): 0.7, ("Doubtful", "star"): 0.6, ("Doubtful", "key_player"): 0.4,
                   ("Questionable", "star"): 0.3, ("Questionable", "key_player"): 0.2}


def inferred_status(raw: Column, details: Column) -> Column:
    """First status word found in either text; anything else counts as out."""
    out = None
    for word, status in STATUS_WORDS.items():
        hit = nvl(F.upper(raw).contains(word), False) | nvl(F.upper(details).contains(word), False)
        out = F.when(hit, status) if out is None else out.when(hit, status)
    return out.otherwise("Out")


def match_players(injuries: DataFrame, players: DataFrame) -> DataFrame:
    """Player of a report: same name and team, or same name when the team is unknown.

    Among several candidates the highest id counts, so both sides join on keys
    that are unique on the player side.
    """
    p = players.select(name_key("player_name").alias("_key"), F.col("team_abbreviation").alias("_abbr"),
                       F.struct("player_id", F.col("team_id").alias("player_team_id")).alias("_p"))
    exact = p.groupBy("_key", "_abbr").agg(F.max("_p").alias("_exact"))
    any_team = p.groupBy("_key").agg(F.max("_p").alias("_any"))
    i = injuries.withColumn("_key", name_key("player_name")).withColumn("_abbr", F.col("team_abbrev"))
    out = i.join(exact, ["_key", "_abbr"], "left").join(any_team, "_key", "left")
    best = F.when(F.col("team_abbrev") == "UNK", F.col("_any")).otherwise(F.col("_exact"))
    return out.withColumn("_best", best).select(*injuries.columns, "_best.player_id", "_best.player_team_id")


@model("injury_star_reports", table=True)
def injury_star_reports(m: Models) -> DataFrame:
    """Injury reports of star and key players with the team they count for."""
    teams = m["stg_teams"].select("team_id", F.col("team_abbreviation").alias("team_abbrev"))
    # the squads are looked through twice
    reports = match_players(m["stg_injuries"].filter("status <> 'N/A'"), kept(m["players"], "squads"))
    stars = m["int_star_players"].select("player_id", "player_tier", "impact_score")
    return reports.join(stars, "player_id").join(teams, "team_abbrev", "left").select(
        "injury_id", "capture_date", "player_id", "player_tier", "impact_score",
        F.coalesce("team_id", "player_team_id").alias("team_id"),
        inferred_status(F.col("status_raw"), F.col("injury_details")).alias("inferred_status"),
    )


_INJURY_COUNTS = [f"{t}_players_{s}" for s in ("out", "doubtful", "questionable") for t in ("star", "key")]


@model("int_game_injury_features")
def game_injuries(m: Models) -> DataFrame:
    side = F.explode(F.array(*[
        F.struct(F.col(f"{s}_team_id").alias("team_id"), F.lit(s == "home").alias("is_home")) for s in ("home", "away")]))
    sides = m.games.select("game_id", "game_date", "is_completed", side.alias("s")).select("game_id", "game_date", "is_completed", "s.*")

    # Reports known by the day after the game, at most the 100 latest, once per (team, day).
    hit = latest_n_asof(sides, m["injury_star_reports"], ["team_id"], "game_date", "capture_date", ["injury_id"], 100, lag_days=1)
    st, tier = F.col("inferred_status"), F.col("player_tier")
    tiers = {"star": "star", "key": "key_player"}
    weight = F.lit(0.0)
    for (s, t), w in ABSENCE_WEIGHTS.items():
        weight = F.when((st == s) & (tier == t), w).otherwise(weight)
    absent = st.isin("Out", "Doubtful")
    # Distinct players: one row per (team, day, player) first, then sums of its marks.
    marks = {f"{t}_players_{s}": (st == s.capitalize()) & (tier == tiers[t]) for s in ("out", "doubtful", "questionable") for t in ("star", "key")}
    marks["injured_players_count"] = absent
    per_player = hit.groupBy("team_id", "game_date", "player_id").agg(
        *[F.max(flag(c)).alias(n) for n, c in marks.items()], F.sum(F.col("impact_score") * weight).alias("injury_impact_score"))
    reported = per_player.groupBy("team_id", "game_date").agg(
        *[F.sum(n).alias(n) for n in marks], F.sum("injury_impact_score").alias("injury_impact_score"), F.max("injured_players_count").alias("has_key_injury"))
    # Without a report: stars of the team that did not play = all of them minus those who played.
    stars = m["int_star_players"]
    n_star, n_key = flag(F.col("player_tier") == "star"), flag(F.col("player_tier") == "key_player")

    def totals(prefix):
        return [F.sum(n_star).alias(f"{prefix}star"), F.sum(n_key).alias(f"{prefix}key"), F.sum("impact_score").alias(f"{prefix}impact")]

    squad = stars.groupBy("team_id").agg(*totals("all_"))
    played = _appearances(m).select("game_id", "player_id").distinct().join(stars, "player_id").groupBy("game_id", "team_id").agg(*totals("on_"))
    rows = attach(attach(sides, reported, ["team_id", "game_date"]), squad, ["team_id"]).join(played, ["game_id", "team_id"], "left")

    def missing(c):
        return F.when(F.col("is_completed"), F.col(f"all_{c}") - nvl(f"on_{c}", 0))

    fallback = {
        "star_players_out": missing("star"), "key_players_out": missing("key"), "injury_impact_score": F.round(missing("impact"), 11),
        "injured_players_count": missing("star") + missing("key"), "has_key_injury": flag(missing("star") + missing("key") > 0),
    }
    names = [*_INJURY_COUNTS, "injury_impact_score", "injured_players_count", "has_key_injury"]

    def value(c):
        if c not in fallback:
            return nvl(c, 0)
        return F.coalesce(F.nullif(F.col(c), F.lit(0)), fallback[c], F.lit(0))

    rows = rows.select("game_id", "is_home", *[value(c).alias(c) for c in names])
    from ..operators.entity_rows import to_game_rows

    out = to_game_rows(m.games, rows, {c: 0.0 if c == "injury_impact_score" else 0 for c in names},
                       {"injury_impact_diff": "injury_impact_score", "star_players_out_diff": "star_players_out"})
    return out


@model("team_injury_features")
def team_injury_features(m: Models) -> DataFrame:
    r = m["stg_injuries"].filter("status <> 'N/A'")
    label = F.concat("player_name", F.lit(" ("), "status", F.lit(")"))
    per_day = r.groupBy("capture_date", "team_abbrev").agg(
        F.count(F.lit(1)).alias("injured_players"),
        *[F.sum(flag(F.col("status") == s)).alias(f"players_{s.lower()}") for s in STATUS_WORDS.values()],
        # One day and team: a squad's worth of names, sorted so the text is stable.
        F.array_join(F.sort_array(F.collect_list(label)), ", ").alias("injury_list"),
    )
    return with_updated_at(per_day, m.loaded_at)
