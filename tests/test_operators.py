"""Operators against brute force, with ties, same-day rows, gaps and small blocks."""

import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foretally.operators import asof, history, merge, streaks

DAY0 = dt.date(2024, 1, 1)


def rows_for(seed, n=120, ents=3, days=25, hot=0.5):
    """Random facts; one entity holds about half of all rows."""
    rnd = random.Random(seed)
    return [(i, 0 if rnd.random() < hot else rnd.randrange(ents), DAY0 + dt.timedelta(days=rnd.randrange(days)), rnd.randrange(-5, 20), rnd.choice("WL")) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, ent int, day date, x int, s string")


def by_entity(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


@pytest.mark.parametrize("block", [5, 7, 1000])
def test_prior_rows_equals_brute_force_for_any_block_size(spark, block):
    rows = rows_for(1)
    got = history.prior_rows(frame(spark, rows), ["ent"], "day", ["id"], depth=4, block_rows=block, exprs=lambda w: {
        "s3": F.sum("x").over(w(-3, -1)), "far": F.sum("x").over(w(-4, -3)), "now": F.sum("x").over(w(-2, 0)), "prev": F.lag("x").over(w(None, None))})
    want = {}
    for e, rs in by_entity(rows).items():
        for i, r in enumerate(rs):
            def total(a, b):
                part = [q[3] for q in rs[max(0, a):max(0, b)]]
                return sum(part) if part else None
            want[r[0]] = (total(i - 3, i), total(i - 4, i - 2), total(i - 2, i + 1), rs[i - 1][3] if i else None)
    assert {r.id: (r.s3, r.far, r.now, r.prev) for r in got.collect()} == want


def test_prior_days_leaves_same_day_out(spark):
    rows = rows_for(2)
    m = [history.Measure("n", "count", F.col("x")), history.Measure("s7", "sum", F.col("x"), 7), history.Measure("sd", "stddev", F.col("x")), history.Measure("mx", "max", F.col("x"), 3)]
    df = frame(spark, rows)
    got = {r.id: r for r in history.attach(df, history.prior_days(df, ["ent"], "day", m), ["ent", "day"]).collect()}
    for r in rows:
        past = [q for q in rows if q[1] == r[1] and q[2] < r[2]]
        week = [q[3] for q in past if (r[2] - q[2]).days <= 7]
        near = [q[3] for q in past if (r[2] - q[2]).days <= 3]
        g = got[r[0]]
        assert (g.n, g.s7, g.mx) == (len(past), sum(week) if week else None, max(near) if near else None)
        if len(past) > 1:
            mean = sum(q[3] for q in past) / len(past)
            assert math.isclose(g.sd, math.sqrt(sum((q[3] - mean) ** 2 for q in past) / (len(past) - 1)), abs_tol=1e-9)
        else:
            assert g.sd is None


def test_rows_before_day_with_probes(spark):
    rows = rows_for(3)
    facts = [r for r in rows if r[4] == "W"]
    got = history.rows_before_day(frame(spark, facts), ["ent"], "day", ["id"], 2, lambda w: {"s3": F.sum("x").over(w(-2, 0))}, probes=frame(spark, rows), block_rows=4)
    have = {(r.ent, r.day): r.s3 for r in got.collect()}
    for r in rows:
        past = [q for q in sorted(facts, key=lambda q: (q[2], q[0])) if q[1] == r[1] and q[2] < r[2]][-3:]
        assert have[(r[1], r[2])] == (sum(q[3] for q in past) if past else None)


@pytest.mark.parametrize("inclusive", [False, True])
def test_running(spark, inclusive):
    rows = rows_for(4)
    got = {r.id: r.t for r in history.running(frame(spark, rows), ["ent"], "day", ["id"], {"t": F.col("x")}, inclusive).collect()}
    for rs in by_entity(rows).values():
        for i, r in enumerate(rs):
            assert got[r[0]] == sum(q[3] for q in rs[: i + (1 if inclusive else 0)])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_streak_before(spark, seed):
    rows = rows_for(seed, n=60, days=12)
    got = {r.id: (r.streak_state, r.streak_len, r.streak_x) for r in streaks.streak_before(frame(spark, rows), ["ent"], "day", ["id"], "s", {"x": F.col("x")}).collect()}
    for rs in by_entity(rows).values():
        for i, r in enumerate(rs):
            if i == 0:
                assert got[r[0]] == (None, None, None)
                continue
            k = i - 1
            while k > 0 and rs[k - 1][4] == rs[i - 1][4]:
                k -= 1
            assert got[r[0]] == (rs[i - 1][4], i - k, sum(q[3] for q in rs[k:i]))


def test_streak_lengths_by_hand(spark):
    days = [(i, 1, DAY0 + dt.timedelta(days=i), 1, s) for i, s in enumerate("WWLWWW")]
    got = streaks.streak_before(frame(spark, days), ["ent"], "day", ["id"], "s").orderBy("id").collect()
    wins = [r.streak_len if r.streak_state == "W" else 0 for r in got]
    assert wins == [0, 1, 2, 0, 1, 2]


def test_asof_day_strict_ttl_and_ties(spark):
    left = spark.createDataFrame([(1, "a", dt.date(2024, 1, 10)), (2, "a", dt.date(2024, 1, 1)), (3, "b", dt.date(2024, 3, 1)), (4, "c", dt.date(2024, 1, 1))], "id int, k string, day date")
    right = spark.createDataFrame([("a", dt.date(2024, 1, 10), 9, 1), ("a", dt.date(2024, 1, 8), 8, 1), ("a", dt.date(2024, 1, 8), 88, 2), ("b", dt.date(2024, 1, 1), 5, 1)], "k string, day date, v int, tie int")
    strict = {r.id: r.v for r in asof.asof_day(left, right, ["k"], "day", ["v"], ["tie"]).collect()}
    assert strict == {1: 88, 2: None, 3: 5, 4: None}
    loose = {r.id: r.v for r in asof.asof_day(left, right, ["k"], "day", ["v"], ["tie"], strict=False, ttl_days=30).collect()}
    assert loose == {1: 9, 2: None, 3: None, 4: None}


@pytest.mark.parametrize("strict", [True, False])
def test_asof_prior_equals_nested_loop(spark, strict):
    rnd = random.Random(9)
    t0 = dt.datetime(2024, 1, 1)
    lrows = [(i, rnd.randrange(3), t0 + dt.timedelta(hours=rnd.randrange(200))) for i in range(60)]
    rrows = [(rnd.randrange(3), t0 + dt.timedelta(hours=rnd.randrange(200)), i) for i in range(40)]
    left, right = spark.createDataFrame(lrows, "id int, k int, ts timestamp"), spark.createDataFrame(rrows, "k int, ts timestamp, v int")
    got = {r.id: r.v for r in asof.asof_prior(left, right, ["k"], "ts", ["v"], ["v"], strict=strict).collect()}
    for i, k, ts in lrows:
        past = [(t, v) for kk, t, v in rrows if kk == k and (t < ts or (t == ts and not strict))]
        assert got[i] == (max(past)[1] if past else None)


def test_latest_n_asof_equals_nested_loop(spark):
    rnd = random.Random(5)
    lrows = [(rnd.randrange(3), DAY0 + dt.timedelta(days=rnd.randrange(30))) for _ in range(40)]
    rrows = [(rnd.randrange(3), DAY0 + dt.timedelta(days=rnd.randrange(30)), i) for i in range(90)]
    left, right = spark.createDataFrame(lrows, "k int, day date"), spark.createDataFrame(rrows, "k int, rday date, v int")
    hit = asof.latest_n_asof(left, right, ["k"], "day", "rday", ["v"], 4, lag_days=1)
    got = {}
    for r in hit.collect():
        got.setdefault((r.k, r.day), set()).add(r.v)
    for k, day in set(lrows):
        past = sorted((d, v) for kk, d, v in rrows if kk == k and d <= day + dt.timedelta(days=1))[-4:]
        assert got.get((k, day), set()) == {v for _, v in past}


def test_keyed_writes(spark):
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 0)], "k int, v string, n int")
    b = spark.createDataFrame([(2, "x", 1), (4, "y", 1), (4, "z", 2)], "k int, v string, n int")
    as_set = lambda df: sorted((r.k, r.v) for r in df.collect())
    assert as_set(merge.upsert(t, b, ["k"], ["n"])) == [(1, "a"), (2, "x"), (3, "c"), (4, "z")]
    assert as_set(merge.append_new(t, b, ["k"], ["n"])) == [(1, "a"), (2, "b"), (3, "c"), (4, "z")]
    assert as_set(merge.replace_keys(t, b, ["k"])) == [(1, "a"), (2, "x"), (3, "c"), (4, "y"), (4, "z")]
    once = merge.upsert(t, b, ["k"], ["n"])
    assert as_set(merge.upsert(once, b, ["k"], ["n"])) == as_set(once)
    p = merge.patch(t, spark.createDataFrame([(2, None, 5), (3, "q", 5)], "k int, v string, n int"), ["k"], ["n"], ["v"])
    assert sorted((r.k, r.v, r.n) for r in p.collect()) == [(1, "a", 0), (2, "b", 0), (3, "q", 0)]
