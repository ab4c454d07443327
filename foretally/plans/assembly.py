"""Feature groups: the game models joined per game, with defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.entity_rows import filled, to_game_rows
from .registry import Models, model

IDS = ["game_id", "game_date", "home_team_id", "away_team_id"]
AT_ONCE = 3

# Features whose name holds one of the words below and whose published default is a half all the same.
HALF = {f"{side}_{name}" for side in ("home", "away") for name in ("win_pct_vs_similar_momentum", "win_pct_with_rest_advantage")}

# Words in a feature name that decide its neutral value, first match counts.
NEUTRAL = [
    (("_diff", "trend", "divergence", "momentum", "acceleration", "home_advantage", "advantage"), 0.0),
    (("underdog_win_pct",), 0.3),
    (("win_pct", "opponent_strength", "opponent_quality", "sos_", "performance_vs_quality", "similarity_score", "compatibility"), 0.5),
]


def neutral(name: str, kind: T.DataType):
    """Value of a feature for a game the upstream model does not cover."""
    if isinstance(kind, T.BooleanType):
        return False
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return 30 if name.endswith("playoff_rank") else 0
    if name in HALF:
        return 0.5
    if name.endswith("_underdog_win_pct") or name == "underdog_win_pct":
        return 0.3
    for words, value in NEUTRAL:
        if value != 0.3 and any(w in name for w in words):
            return value
    return 0.0


@model("game_keys", table=True, by="game_id")
def game_keys(m: Models) -> DataFrame:
    """The keys of all games, bucketed: what the pieces of a feature group are joined to."""
    return m.games.select(*IDS)


def beside(left: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Left joins on game_id, columns in the order of the tables. All columns of a table travel as one struct and are taken out
    behind the last join, so a join does not copy the hundreds of columns of the tables before it one by one."""
    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select("game_id", F.struct(*[f"`{c}`" for c in df.columns if c != "game_id"]).alias(name))

    out, flat = packed(left, "_t"), [c if c == "game_id" else f"_t.`{c}`" for c in left.columns]
    for i, table in enumerate(tables):
        out = out.join(packed(table, f"_t{i}"), "game_id", "left")
        flat += [f"_t{i}.`{c}`" for c in table.columns if c != "game_id"]
    return out.select(*flat)


def join_on_game(m: Models, parts: list[DataFrame]) -> DataFrame:
    """Left joins on game_id only; every part comes hashed by game_id, so rows move once.

    Every join in a stage keeps sort buffers per task, so at most `AT_ONCE` parts are joined in one; what they give is
    written in buckets of game_id before the next ones. The written pieces are joined by the reader, bucket by bucket, without
    moving a row or writing it again.
    """
    games, pieces = m["game_keys"], []
    for at in range(0, len(parts), AT_ONCE):
        piece = games.select("game_id")
        for p in parts[at : at + AT_ONCE]:
            piece = piece.join(p, "game_id", "left")
        pieces.append(m.written(piece, "piece", "game_id"))
    out = beside(games.select(*IDS), pieces)
    return out.selectExpr(*IDS, *[
        f"{filled(f.name, neutral(f.name, f.dataType))} as `{f.name}`" for f in out.schema.fields if f.name not in IDS])


def from_model(m: Models, name: str, drop: tuple[str, ...] = ()) -> DataFrame:
    return m[name].drop("game_date", "home_team_id", "away_team_id", *drop)


def from_sides(m: Models, name: str, rename: dict[str, str]) -> DataFrame:
    """A (game, team) model as home_* / away_* columns per game."""
    host = m.games.select("game_id", "home_team_id")
    rows = m[name].selectExpr("game_id", "team_id", *[f"`{c}` as `{a}`" for c, a in rename.items()]).join(host, "game_id")
    rows = rows.withColumn("is_home", F.col("team_id") == F.col("home_team_id"))
    return to_game_rows(m.games, rows, {a: None for a in rename.values()}, keep=("game_id",))


def with_diffs(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"home_{c} - away_{c} as `{n}`" for n, c in names.items()])


BASIC = ("int_team_streaks", "int_team_streak_qual", "int_team_rest_days", "int_team_cum_fatigue", "int_team_weighted_momentum",
         "int_team_ctx_streaks", "int_team_recent_mom_exp")


@model("int_momentum_group_basic")
def group_basic(m: Models) -> DataFrame:
    return join_on_game(m, [from_model(m, n, ("win_streak_length_diff",)) for n in BASIC])


@model("int_momentum_group_h2h")
def group_h2h(m: Models) -> DataFrame:
    return join_on_game(m, [
        from_model(m, "int_team_h2h_stats", ("home_h2h_wins", "away_h2h_wins", "h2h_total_games")),
        from_model(m, "int_team_rivalry_ind"), from_model(m, "int_team_opp_specific_perf")])


OPPONENT = ("int_team_opponent_quality", "int_team_opp_tier_perf", "int_team_opp_tier_ha", "int_team_perf_vs_opp_qual_rest",
            "int_team_perf_vs_similar_qual", "int_team_quality_adj_perf", "int_team_opp_similarity_perf", "int_team_recent_perf_wt_opp_qual")
OPPONENT_DIFFS = {f"{c}_diff": c for c in (
    "win_pct_vs_strong_by_rest", "win_pct_vs_weak_by_rest", "win_pct_vs_similar_quality", "avg_point_diff_vs_similar_quality",
    "win_pct_vs_similar_opponents", "avg_point_diff_vs_similar_opponents")}


@model("int_momentum_group_opponent")
def group_opponent(m: Models) -> DataFrame:
    out = join_on_game(m, [from_model(m, n, ("home_rest_bucket", "away_rest_bucket")) for n in OPPONENT])
    return with_diffs(out, OPPONENT_DIFFS)


CONTEXT = ("int_team_home_road_perf", "int_team_home_away_opp_qual", "int_team_home_away_rest_perf", "int_team_clutch_perf",
           "int_team_blowout_perf", "int_team_cb_closeout_perf", "int_team_ot_perf", "int_team_outcome_qual", "int_team_upset_resistance",
           "int_team_favored_underdog_perf", "int_team_road_perf", "int_team_timing_perf")
CONTEXT_DIFFS = {f"{c}_diff": c for c in (
    "blowout_win_pct", "blowout_avg_point_diff", "blowout_frequency", "comeback_win_pct", "closeout_win_pct", "comeback_avg_point_diff",
    "closeout_avg_point_diff", "win_pct_when_favored", "win_pct_when_underdog", "avg_point_diff_when_favored",
    "avg_point_diff_when_underdog", "upset_rate")}
QUARTER = [f"rolling_{n}_q4_{k}" for n in (5, 10) for k in ("ppg", "net_rtg", "win_pct")] + ["season_q4_win_pct_when_won_q4", "q4_wins_count_season"]
RACE = {"overall_rank": "playoff_rank", **{c: c for c in (
    "is_in_playoff_position", "games_back_from_cutoff", "win_pct_diff_from_cutoff", "is_close_to_cutoff", "is_fighting_for_playoff_spot")}}


@model("int_momentum_group_context")
def group_context(m: Models) -> DataFrame:
    # Both upset models have an underdog count; the stricter one keeps its suffix.
    upset = {"home_underdog_game_count": "home_underdog_game_count_upset", "away_underdog_game_count": "away_underdog_game_count_upset"}
    parts = [from_model(m, n).withColumnsRenamed(upset) if n == "int_team_upset_resistance" else from_model(m, n) for n in CONTEXT]
    parts.append(from_sides(m, "int_team_4q_perf", {c: c for c in QUARTER}))
    side = F.explode(F.array(*[F.struct(F.col(f"{s}_team_id").alias("team_id"), F.lit(s == "home").alias("is_home")) for s in ("home", "away")]))
    race = m.games.select("game_id", "game_date", side.alias("s")).select("game_id", "game_date", "s.*").join(
        m["int_team_playoff_ctx"], ["game_date", "team_id"]).withColumnsRenamed(RACE)
    parts.append(to_game_rows(m.games, race, {a: None for a in RACE.values()}, keep=("game_id",)))
    return with_diffs(join_on_game(m, parts), CONTEXT_DIFFS)


DIVERGENCE = {**{f"form_divergence_{k}_{n}": f"{k}_divergence_{n}" for k in ("win_pct", "net_rtg", "ppg", "opp_ppg") for n in (5, 10)},
              **{f"form_divergence_magnitude_win_pct_{n}": f"form_divergence_magnitude_win_pct_{n}" for n in (5, 10)}}
TREND_KEYS = ("win_pct", "net_rtg", "ppg", "off_rtg", "efg_pct", "ts_pct", "opp_ppg", "def_rtg")
ACCEL = [f"{k}_acceleration" for k in ("win_pct", "point_diff", "ppg", "defensive", "net_rtg")]
TRENDS = ("int_team_recent_form_trend", "int_team_mom_accel", "int_team_perf_consistency", "int_team_matchup_perf", "int_team_perf_vs_similar_mom",
          "int_team_perf_vs_rest_ctx", "int_team_perf_rest_adv", "int_team_perf_by_rest_combo", "int_team_matchup_compat", "int_team_perf_by_pace_ctx")
TREND_DIFFS = {**{f"{c}_diff": c for c in ACCEL}, **{f"{c}_diff": c for c in (
    "win_pct_vs_similar_momentum", "avg_point_diff_vs_similar_momentum", "fast_pace_win_pct", "fast_pace_avg_point_diff",
    "slow_pace_win_pct", "slow_pace_avg_point_diff")}}


@model("int_momentum_group_trends")
def group_trends(m: Models) -> DataFrame:
    parts = [
        from_sides(m, "int_team_form_divergence", DIVERGENCE),
        from_sides(m, "int_team_perf_trends", {f"{k}_trend": f"{k}_trend" for k in TREND_KEYS}),
        from_sides(m, "int_team_recent_momentum", {f"recent_{k}_momentum": f"recent_{k}_momentum" for k in TREND_KEYS}),
        from_sides(m, "int_team_perf_accel", {c: c for c in ACCEL}),
        *[from_model(m, n, ("rest_combination_key",)) for n in TRENDS],
    ]
    return with_diffs(join_on_game(m, parts), TREND_DIFFS)


GROUPS = tuple(f"int_momentum_group_{g}" for g in ("basic", "h2h", "opponent", "context", "trends"))


def divergence_aliases() -> dict[str, str]:
    """Second names of the divergence columns: by form, and net rating standing in for both ratings."""
    out = {}
    for s in ("home", "away"):
        for n in (5, 10):
            out |= {f"{s}_form_divergence_{k}_{n}": f"{s}_{k}_divergence_{n}" for k in ("win_pct", "ppg", "opp_ppg", "net_rtg")}
            out |= {f"{s}_{k}_divergence_{n}": f"{s}_net_rtg_divergence_{n}" for k in ("off_rtg", "def_rtg")}
    return out


def with_momentum(rows: DataFrame, groups: list[DataFrame]) -> DataFrame:
    """Rows of games with the columns of the groups and their second names."""
    return beside(rows, groups).selectExpr("*", *[f"{src} as {name}" for name, src in divergence_aliases().items()])


@model("int_game_momentum_features")
def game_momentum(m: Models) -> DataFrame:
    """All groups side by side; not written again, as their pieces are joined bucket by bucket in the order of their files."""
    m.together(reversed(GROUPS))  # the longest first
    return with_momentum(m[GROUPS[0]], [from_model(m, g) for g in GROUPS[1:]])
