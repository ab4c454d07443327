"""Queries over operators, keyed writes, quality, incremental runs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from . import incremental
from .functions.numeric import flag, rounded
from .operators import asof, history, merge, pairs, streaks
from .plans.registry import Models
from .plans.views import staging_from_star
from .quality import profile as prof
from .quality import reports, rules


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _models(spark, d) -> Models:
    from .catalog import graph

    return graph(spark, d)


# Operators in generic form, on the event stream ------------------------------------


def asof_events_query(spark, d):
    """Latest earlier click of the user before each purchase, at most 30 days old."""
    e = _t(spark, d, "events")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", F.col("value").alias("amount"))
    right = e.filter("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    return asof.asof_prior(left, right, ["user_id"], "ts", ["click_id", "click_value"], ["click_id"], strict=True, ttl_seconds=30 * 86400)


def asof_at_or_before_query(spark, d):
    e = _t(spark, d, "events")
    left = e.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    right = e.select("user_id", "ts", F.col("event_id").alias("last_id"))
    return asof.asof_prior(left, right, ["user_id"], "ts", ["last_id"], ["last_id"], strict=False)


def prior_days_events_query(spark, d):
    """Value of the user's last 7 and 30 days before each event day."""
    e = _t(spark, d, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    m = [history.Measure("n_7", "count", F.col("value"), 7), history.Measure("avg_30", "avg", F.col("value"), 30),
         history.Measure("max_all", "max", F.col("value")), history.Measure("sd_all", "stddev", F.col("value"))]
    return history.attach(e, history.prior_days(e, ["user_id"], "day", m), ["user_id", "day"])


def prior_rows_events_query(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "value", "event_type", F.to_date("ts").alias("day"))
    return history.prior_rows(e, ["user_id"], "day", ["event_id"], depth=10, exprs=lambda w: {
        "avg_5": F.avg("value").over(w(-5, -1)), "min_10": F.min("value").over(w(-10, -1)), "prev_type": F.lag("event_type").over(w(None, None))})


def decayed_events_query(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    return history.prior_rows(e, ["user_id"], "day", ["event_id"], depth=8, exprs=lambda w: {"decayed_8": history.decayed(w, "value", 8, 0.2)})


def running_events_query(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    return history.running(e, ["user_id"], "day", ["event_id"], {"n": F.lit(1), "errors": flag(F.col("event_type") == "error")})


def streaks_events_query(spark, d):
    """Run of equal event types that ended just before each event."""
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))
    return streaks.streak_before(e, ["user_id"], "day", ["event_id"], "event_type", {"value": F.col("value")})


def latest_n_asof_query(spark, d):
    """Up to 5 latest reports per team and game day."""
    s = staging_from_star(spark, d)
    g = s["stg_games"].select(F.concat(F.lit("T"), "home_team_id").alias("team_abbrev"), "game_date")
    hit = asof.latest_n_asof(g, s["stg_injuries"].select("team_abbrev", "capture_date", "injury_id", "status"), ["team_abbrev"], "game_date", "capture_date", ["injury_id"], 5, lag_days=1)
    return hit.groupBy("team_abbrev", "game_date").agg(F.count(F.lit(1)).alias("n"), F.max("injury_id").alias("newest"), F.sum(flag(F.col("status") == "Out")).alias("out"))


def pair_rows_query(spark, d):
    g = pairs.with_pair(_models(spark, d).played)
    return g.groupBy("lo_id", "hi_id").agg(F.count(F.lit(1)).alias("games"), F.sum("lo_win").alias("lo_wins"), F.sum("hi_win").alias("hi_wins"), F.avg("lo_margin").alias("lo_margin"))


def entity_rows_query(spark, d):
    return _models(spark, d).tg


def feature_view(spark, d):
    """Point-in-time retrieval: rolling features per asked (team, day), no older than 365 days."""
    m = _models(spark, d)
    asked = m.games.select("game_id", F.col("home_team_id").alias("team_id"), "game_date")
    cols = ["rolling_5_ppg", "rolling_10_win_pct", "rolling_10_net_rtg", "wins_last_5"]
    return asof.asof_day(asked, m["int_team_rolling_stats"], ["team_id"], "game_date", cols, ["game_id"], strict=False, ttl_days=365)


def game_feature_view(spark, d):
    """All fields of the game feature view, each game asked for between the day before and 398 days after it."""
    from .plans import mart

    m = _models(spark, d)
    asked = m.games.select("game_id", F.expr("date_add(game_date, cast(game_id % 400 as int) - 1)").alias("asked_on"))
    return mart.game_feature_view(m["mart_game_features"], asked)


# Keyed writes -----------------------------------------------------------------------


def _split(spark, d):
    """Stored table (all orders), and a batch of all orders that updates a third of the keys, adds the others as
    new keys, and repeats every key once with an older or newer load."""
    g = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(0).alias("load_no"))
    key = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).otherwise(-F.col("o_orderkey"))
    batch = g.select(key.alias("o_orderkey"), "o_orderstatus", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit(1).alias("load_no"))
    again = batch.withColumn("load_no", F.when(F.col("o_orderkey") % 2 == 0, 2).otherwise(0)).withColumn("o_orderstatus", F.lit("X"))
    return g, batch.unionByName(again)


def wr_upsert(spark, d):
    t, b = _split(spark, d)
    return merge.upsert(t, b, ["o_orderkey"], ["load_no"])


def wr_append_new(spark, d):
    t, b = _split(spark, d)
    return merge.append_new(t, b, ["o_orderkey"], ["load_no"])


def wr_only_new_keys(spark, d):
    t, b = _split(spark, d)
    return merge.only_new_keys(b.select("o_orderkey").distinct(), t, ["o_orderkey"])


def wr_patch(spark, d):
    t, b = _split(spark, d)
    b = b.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")))
    return merge.patch(t, b, ["o_orderkey"], ["load_no"], ["o_orderstatus"])


def wr_replace_keys(spark, d):
    t, b = _split(spark, d)
    return merge.replace_keys(t, b, ["o_orderkey"])


def wr_replace_interval(spark, d):
    g = _models(spark, d).games.select("game_id", "game_date", "home_score")
    return merge.replace_interval(g, g.filter("game_id % 2 = 0").withColumn("home_score", F.lit(-1)), "game_date", "1996-01-01", "1997-01-01")


def wr_activate(spark, d):
    """One active order per customer: the dearest one."""
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", (F.col("o_orderkey") % 2 == 0).alias("is_active"))
    best = o.filter("o_custkey % 3 <> 0").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("o_orderkey"))
    return merge.activate(o, "o_custkey", "o_orderkey", best)


# Quality ----------------------------------------------------------------------------

LINE_RULES = [
    rules.Rule("ship_not_null", "not_null", ("l_shipdate", "l_orderkey")), rules.Rule("discount_range", "range", ("l_discount",), min=0.0, max=0.08),
    rules.Rule("quantity_min", "range", ("l_quantity",), min=3), rules.Rule("flag_values", "enum", ("l_returnflag",), values=("A", "N")),
    rules.Rule("line_key", "unique", ("l_orderkey", "l_linenumber")), rules.Rule("part_key", "unique", ("l_partkey",)),
    rules.Rule("order_exists", "referential", ("l_orderkey",), ref="orders", ref_columns=("o_orderkey",))]


def dq_lineitem_rules(spark, d):
    return rules.check(_t(spark, d, "lineitem"), LINE_RULES, {"orders": _t(spark, d, "orders").withColumn("o_orderkey", F.expr("case when o_orderstatus = 'P' then -o_orderkey else o_orderkey end"))})


def dq_orders_rules(spark, d):
    return rules.check(_t(spark, d, "orders"), [
        rules.Rule("priority_format", "format", ("o_orderpriority",), pattern=r"^[1-3]-[A-Z]+"),
        rules.Rule("customer_exists", "referential", ("o_custkey",), ref="customer", ref_columns=("c_custkey",))], {"customer": _t(spark, d, "customer").withColumn("c_custkey", F.expr("case when c_nationkey = 3 then -c_custkey else c_custkey end"))})


def dq_game_rules(spark, d):
    g = _models(spark, d).games
    return rules.check(g, [rules.Rule("score_range", "range", ("home_score",), min=85, max=135), rules.Rule("winner_set", "not_null", ("winner_team_id",)),
                           rules.Rule("game_key", "unique", ("game_id",))])


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


def dq_profile(spark, d):
    p = prof.profile(_t(spark, d, "lineitem"), PROFILED, exact_distinct=True)
    return p.drop("min_value", "max_value")


def dq_histogram(spark, d):
    return prof.histogram(_t(spark, d, "lineitem"), "l_extendedprice")


def dq_drift(spark, d):
    """The whole table against itself with larger quantities, lost discounts and constant prices for some flags."""
    li = _t(spark, d, "lineitem").select("l_returnflag", *PROFILED)
    later = li.withColumns({
        "l_quantity": F.expr("case when l_returnflag = 'R' then l_quantity * 1.5D else l_quantity end"), "l_discount": F.expr("case when l_returnflag <> 'A' then l_discount end"),
        "l_extendedprice": F.expr("case when l_returnflag = 'N' then 1000D else l_extendedprice end")})
    return prof.drift(*(prof.profile(x, PROFILED, exact_distinct=True) for x in (li, later)))


def dq_anomalies(spark, d):
    e = _t(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))
    return prof.anomalies(e, ["event_type"], "day", "total")


def dq_freshness(spark, d):
    return prof.freshness(_t(spark, d, "events"), "ts", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), 24)


def dq_training_report(spark, d):
    m = _models(spark, d)
    mart = m["mart_game_features"]
    return reports.training_data_report(mart.select("game_id", "game_date", "home_win", "home_rest_days", "home_injury_impact_score"), m.games, "1996-10-01", ("home_rest_days", "home_injury_impact_score"))


def dq_rows_per_year(spark, d):
    return reports.rows_per_year(_models(spark, d).played)


def dq_raw_load_report(spark, d):
    m = _models(spark, d)
    return reports.raw_load_report(m.games, m["stg_player_boxscores"], m["stg_injuries"])


def dq_injury_matching(spark, d):
    from .plans.players import match_players

    m = _models(spark, d)
    return reports.injury_match_report(match_players(m["stg_injuries"].filter("status <> 'N/A'"), m["players"]), m["int_star_players"])


def dq_date_alignment(spark, d):
    m = _models(spark, d)
    return reports.date_alignment(m.games, m["stg_injuries"])


def dq_fallback(spark, d):
    m = _models(spark, d)
    first = m["injury_star_reports"].groupBy("team_id").agg(F.min("capture_date").alias("first_report"))
    return reports.fallback_report(m.games.select("game_id", "game_date", "home_team_id", "away_team_id", "is_completed"), m["int_game_injury_features"], first)


# Incremental runs ------------------------------------------------------------------------


def in_interval_run(spark, d):
    """One year of streaks with earlier history as context."""
    return incremental.run_interval(spark, staging_from_star(spark, d), "int_team_streaks", "1997-01-01", "1998-01-01")


def in_backfill(spark, d):
    """Clutch features of three years, written year by year and read back."""
    from .plans.registry import shared_dir
    import uuid

    path = f"{shared_dir(spark)}/backfill-{uuid.uuid4().hex[:8]}"
    incremental.backfill(spark, staging_from_star(spark, d), "int_team_clutch_perf", path, date(1995, 1, 1), date(1998, 1, 1), None)
    return spark.read.parquet(path).drop("day")


def in_backfill_reads(spark, d):
    """Rows each yearly chunk of that run reads: games of its own year, and one row of state per team and year."""
    from .plans.registry import shared_dir
    import uuid

    seen = []

    def note(c):
        games, state = c.rows_read("stg_games")
        seen.append((c.start, c.end, games, state))

    path = f"{shared_dir(spark)}/backfill-{uuid.uuid4().hex[:8]}"
    incremental.backfill(spark, staging_from_star(spark, d), "int_team_clutch_perf", path, date(1995, 1, 1), date(1999, 1, 1), None, note)
    return spark.createDataFrame(seen, "chunk_start date, chunk_end date, game_rows long, state_rows long")


def in_table_diff(spark, d):
    g = _models(spark, d).games.select("game_id", "game_date", "home_score", "away_score")
    b = g.filter("game_id % 11 <> 0").withColumn("home_score", F.when(F.col("game_id") % 5 == 0, 0).otherwise(F.col("home_score"))).unionByName(
        g.filter("game_id % 13 = 0").withColumn("game_id", -F.col("game_id") - 1))
    return incremental.table_diff(g, b, ["game_id"])


def in_coverage(spark, d):
    return incremental.coverage(_models(spark, d).games, 1990, 2004)


def in_best_version(spark, d):
    r = _models(spark, d)["int_team_rest_days"]
    return incremental.best_version({"full": r, "even": r.filter("game_id % 2 = 0"), "zeroed": r.withColumn("home_rest_days", F.lit(0))}, "home_rest_days")


QUERIES = {f.__name__.removesuffix("_query"): f for f in (
    asof_events_query, asof_at_or_before_query, prior_days_events_query, prior_rows_events_query, decayed_events_query, running_events_query, streaks_events_query,
    latest_n_asof_query, pair_rows_query, entity_rows_query, feature_view, game_feature_view, wr_upsert, wr_append_new, wr_only_new_keys, wr_patch, wr_replace_keys,
    wr_replace_interval, wr_activate, dq_lineitem_rules, dq_orders_rules, dq_game_rules, dq_profile, dq_histogram, dq_drift, dq_anomalies,
    dq_freshness, dq_training_report, dq_rows_per_year, dq_raw_load_report, dq_injury_matching, dq_date_alignment, dq_fallback,
    in_interval_run, in_backfill, in_backfill_reads, in_table_diff, in_coverage, in_best_version)}
