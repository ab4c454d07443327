"""Aggregates over what happened before a row, without one task per entity.

A window partitioned by the entity alone would put the whole history of the
busiest entity into one task. These operators split an entity's history:

* `prior_days`  - partial aggregates per (entity, day), combined map-side, then a
  window over days. The window sees one row per entity and day, whatever the
  number of facts.
* `running`     - totals up to a row: totals of earlier days from the day table
  plus a window inside the (entity, day) group.
* `prior_rows`  - frames of n rows: the day table says at which rank of its entity
  each day starts, and whole days make blocks of about equal rank range; each block
  also receives the days that hold the last `depth` rows before it, so every frame
  is complete, rows move once, and no task holds more than one block.
* `rows_before_day` - the last n rows strictly before the row's own day.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import col
from .carry import active, earlier_days, earlier_rows, latest
from .scratch import kept

BLOCK_ROWS = 50_000
_START = Window.unboundedPreceding


@dataclass(frozen=True)
class Measure:
    """One aggregate over earlier days; `days` limits how far back it looks."""

    name: str
    fn: str  # sum, count, avg, min, max, stddev
    value: Column
    days: int | None = None


def _partials(ms: list[Measure]) -> list[Column]:
    out = []
    for m in ms:
        v = m.value
        if m.fn in ("sum", "avg", "stddev"):
            out.append(F.sum(v).alias(f"_s_{m.name}"))
        if m.fn in ("count", "avg", "stddev"):
            out.append(F.count(v).alias(f"_n_{m.name}"))
        if m.fn == "stddev":
            d = v.cast("double")
            out.append(F.sum(d * d).alias(f"_q_{m.name}"))
        if m.fn in ("min", "max"):
            out.append(getattr(F, m.fn)(v).alias(f"_x_{m.name}"))
    return out


def _combined(m: Measure, by: list[str], day: str) -> str:
    keys = ", ".join(f"`{c}`" for c in by)
    low = "unbounded" if m.days is None else str(m.days)
    w = f"over (partition by {keys} order by unix_date(`{day}`) range between {low} preceding and 1 preceding)"
    s, n = f"sum(`_s_{m.name}`) {w}", f"sum(`_n_{m.name}`) {w}"
    if m.fn == "sum":
        return s
    if m.fn == "count":
        return f"coalesce({n}, 0L)"
    if m.fn == "avg":
        return f"try_divide(cast({s} as double), cast({n} as double))"
    if m.fn == "stddev":
        squares = f"sum(`_q_{m.name}`) {w}"
        var = f"try_divide({squares} - try_divide(cast({s} as double) * {s}, cast({n} as double)), cast({n} - 1 as double))"
        return f"case when {n} > 1 then sqrt(greatest({var}, 0D)) end"
    return f"{m.fn}(`_x_{m.name}`) {w}"


def prior_days(facts: DataFrame, by: list[str], day: str, measures: list[Measure]) -> DataFrame:
    """(by, day) -> aggregates over all facts of the same keys on earlier days.

    Same-day facts are left out. The result has one row per (by, day) found in
    `facts`; join it back to the rows that ask.
    """
    daily = facts.groupBy(*by, day).agg(*_partials(measures))
    merge = {c: {"_x_": m.fn}.get(c[:3], "sum") for m in measures for c in daily.columns if c in {f"_{k}_{m.name}" for k in "snqx"}}
    daily = earlier_days(daily, by, day, merge, max((m.days or 0 for m in measures), default=0))
    return daily.selectExpr(*by, day, *[f"{_combined(m, by, day)} as `{m.name}`" for m in measures])


def _keyed(df: DataFrame, by: list[str], day: str) -> DataFrame:
    """Adds `_key`, the keys and day as one value that is never null: a join on it keeps rows whose key or day is null."""
    return df.withColumn("_key", F.struct(*[F.col(c) for c in (*by, day)]))


def _totals_before(df: DataFrame, by: list[str], day: str, sums: dict[str, Column]) -> DataFrame:
    """`_key`, the sums of each day, and as `_c_*` those of all earlier days; an unknown day comes after every other."""
    daily = df.groupBy(*by, day).agg(*[c.alias(n) for n, c in sums.items()])
    daily = earlier_days(daily, by, day, dict.fromkeys(sums, "sum"))
    before = Window.partitionBy(*by).orderBy(F.col(day).asc_nulls_last()).rowsBetween(_START, -1)
    table = daily.select(*by, day, *sums, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_c_{n}") for n in sums])
    return _keyed(table, by, day).drop(*by, day)


def _nulls_last(tie: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tie]


def ranked(df: DataFrame, by: list[str], day: str, tie: list[str], name: str = "_rn") -> DataFrame:
    """Add the 1-based position of each row in its entity's history.

    A null key is an entity like others; rows of unknown day come last, and nulls in `tie` last within a day.
    """
    keyed = _keyed(df, by, day)
    in_day = Window.partitionBy("_key").orderBy(*_nulls_last(tie))
    offsets = _totals_before(df, by, day, {"_in_day": F.count(F.lit(1))}).withColumnRenamed("_c__in_day", "_before")
    return keyed.join(offsets, "_key").withColumn(
        name, (F.col("_before") + F.row_number().over(in_day)).cast("long")
    ).drop("_key")


def prior_rows(
    df: DataFrame,
    by: list[str],
    day: str,
    tie: list[str],
    depth: int,
    exprs: Callable[[Callable[[int, int], object]], dict[str, Column]],
    block_rows: int | None = None,
    keep_rank: bool = False,
) -> DataFrame:
    """Add window expressions over row frames no deeper than `depth` rows.

    `exprs` gets a frame factory `w(lo, hi)` and returns named columns; `lag`
    works with `w(None, None)`. The result does not depend on `block_rows`.
    """
    size = max(block_rows or BLOCK_ROWS, depth + 1)
    if active() is None:
        cut, place = _blocks_of_days(df, by, day, depth, size), [F.col(day).asc_nulls_last(), *_nulls_last(tie)]
    else:
        cut, place = _blocks_of_ranks(earlier_rows(ranked(df, by, day, tie), by, "_rn", depth), depth, size), ["_rn"]
    order = Window.partitionBy(*by, "_blk").orderBy(*place)

    def w(lo, hi):
        return order if lo is None else order.rowsBetween(lo, hi)

    named = exprs(w)
    rank = [] if "_rn" in cut.columns else [(F.first("_before").over(w(_START, 0)) + F.row_number().over(order)).cast("long").alias("_rn")]
    out = cut.select("*", *rank, *[c.alias(n) for n, c in named.items()]).filter((F.col("_blk") == F.col("_own")) & ~F.col("_old"))
    return out.select(*df.columns, *(["_rn", "_before", "_in_day"] if keep_rank else []), *named)


def _blocks_of_days(df: DataFrame, by: list[str], day: str, depth: int, size: int) -> DataFrame:
    """Rows with the block `_own` their day starts in, once per block `_blk` that needs them.

    A block needs the days that end fewer than `depth` rows before its start; as `size` is more than `depth`, a day's end
    and the place `depth - 1` rows behind it lie in at most two blocks, which are the only ones that can need it.
    """
    days = _totals_before(df, by, day, {"_in_day": F.count(F.lit(1))}).withColumnRenamed("_c__in_day", "_before")
    own, end = F.floor(F.col("_before") / size).cast("long"), F.col("_before") + F.col("_in_day")
    later = [F.floor(x / size).cast("long") for x in (end, end + (depth - 1))]
    days = kept(days.withColumn("_own", own).withColumn("_in", F.array_distinct(F.array(own, *later) if depth else F.array(own))), "days")
    return _keyed(df, by, day).join(days, "_key").drop("_key").select("*", F.explode("_in").alias("_blk"), F.lit(False).alias("_old")).drop("_in")


def _blocks_of_ranks(placed: DataFrame, depth: int, size: int) -> DataFrame:
    """Rows of known rank `_rn` with their block `_own` of ranks, and once more in the next block where that needs them."""
    pos = F.pmod(F.col("_rn") - 1, F.lit(size))
    cut = placed.withColumn("_own", F.floor((F.col("_rn") - 1) / F.lit(size)).cast("long"))
    both = F.when(pos >= size - depth, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array(F.col("_own")))
    return cut.withColumn("_blk", F.explode(both))


def running(
    df: DataFrame, by: list[str], day: str, tie: list[str], sums: dict[str, Column], inclusive: bool = False
) -> DataFrame:
    """Add running sums over all earlier rows of the entity (0 at the start); nulls count as in `ranked`."""
    keyed = _keyed(df, by, day)
    carry = _totals_before(df, by, day, {f"_d_{n}": F.sum(c) for n, c in sums.items()}).drop(*[f"_d_{n}" for n in sums])
    inside = Window.partitionBy("_key").orderBy(*_nulls_last(tie)).rowsBetween(_START, 0 if inclusive else -1)
    return keyed.join(carry, "_key").select(
        *df.columns,
        *[(F.col(f"_c__d_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()],
    )


def rows_before_day(
    df: DataFrame,
    by: list[str],
    day: str,
    tie: list[str],
    depth: int,
    exprs: Callable[[Callable[[int, int], object]], dict[str, Column]],
    probes: DataFrame | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """(by, day) -> frame values over the rows strictly before that day.

    `w(-(n-1), 0)` inside `exprs` means the last n rows before the day. The days
    asked for are those of `probes`, or of the rows themselves.
    """
    named: list[str] = []

    def wrapped(w):
        got = exprs(w)
        named.extend(got)
        return got

    rows = prior_rows(df, by, day, tie, depth, wrapped, block_rows, keep_rank=True)
    after = rows.filter(F.col("_rn") == F.col("_before") + F.col("_in_day")).select(
        *by, day, F.struct(*named).alias("_after")
    )
    after = latest(after, by, day)
    prev = Window.partitionBy(*by).orderBy(day).rowsBetween(_START, -1)
    if probes is not None:
        after = after.join(probes.select(*by, day).distinct(), [*by, day], "full")
    known = after.select(*by, day, F.last("_after", ignorenulls=True).over(prev).alias("_p"))
    return known.select(*by, day, *[F.col(f"_p.{n}").alias(n) for n in named])


def attach(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Left join of a (key, day) feature table onto the rows that ask for it, which stay where they are if the table is small."""
    return rows.join(kept(table, "history"), on, "left")


def decayed(w, value: str | Column, n: int, rate: float) -> Column:
    """Exponentially decayed mean of the last n rows: weight exp(-rate * (k-1))."""
    v = col(value)
    parts = [(F.lag(v, k).over(w(None, None)), _exp(rate, k)) for k in range(1, n + 1)]
    return weighted(parts)


def _exp(rate: float, k: int) -> float:
    import math

    return math.exp(-rate * (k - 1))


def weighted(parts: list[tuple[Column, float]]) -> Column:
    """Weighted mean over the parts that are not NULL; NULL when none is."""
    num = sum((F.coalesce(v * F.lit(wt), F.lit(0.0)) for v, wt in parts), F.lit(0.0))
    den = sum((F.when(v.isNotNull(), F.lit(wt)).otherwise(F.lit(0.0)) for v, wt in parts), F.lit(0.0))
    return F.try_divide(num, den)
