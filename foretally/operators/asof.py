"""As-of joins: for each left row the latest right row before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .carry import earlier_rows, latest
from .scratch import kept


def asof_day(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    day: str,
    cols: list[str],
    tie: list[str],
    strict: bool = True,
    ttl_days: int | None = None,
    place: str | None = None,
) -> DataFrame:
    """Latest right row on an earlier day (or the same day when not strict).

    Both sides shrink to one row per (by, day) before the window, so a busy key
    costs one row per day; the fact rows are only joined on (by, day). `place`
    names a number of the right rows that is never null, unique in a key and ordered
    as `tie`: then the newest row of a day is found by hashing, without sorting the rows.
    """
    if place is None:
        newest = right.groupBy(*by, day).agg(
            F.max_by(F.struct(F.col(day).alias("_seen"), *cols), F.struct(*tie)).alias("_row")
        )
    else:
        last = right.groupBy(*by, day).agg(*[F.max_by(c, place).alias(f"_l_{c}") for c in cols])
        newest = last.select(*by, day, F.struct(F.col(day).alias("_seen"), *[F.col(f"_l_{c}").alias(c) for c in cols]).alias("_row"))
    newest = latest(newest, by, day)
    asked = left.select(*by, day).distinct()
    order = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    found = asked.withColumn("_ask", F.lit(True)).join(newest, [*by, day], "full").select(
        *by, day, "_ask", F.last("_row", ignorenulls=True).over(order).alias("_hit")
    )
    hits = found.filter("_ask")
    if ttl_days is not None:
        hits = hits.withColumn("_hit", F.when(F.datediff(day, "_hit._seen") <= ttl_days, F.col("_hit")))
    return left.join(kept(hits.select(*by, day, *[F.col(f"_hit.{c}").alias(c) for c in cols]), "asof"), [*by, day], "left")


def asof_prior(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    time: str,
    cols: list[str],
    tie: list[str],
    strict: bool = True,
    ttl_seconds: int | None = None,
    bucket=None,
) -> DataFrame:
    """Latest right row with time < left time (<= when not strict), any time grain.

    Rows of both sides are compared inside a (by, bucket) group (a day unless
    `bucket` maps the time column to something finer); what lies before the
    bucket comes from a small table with the last right row of each bucket.
    """
    slot = bucket or (lambda c: c.cast("date"))
    time_type = left.schema[time].dataType
    payload = F.struct(F.col(time).alias("_seen"), *[F.col(c) for c in cols])
    rhs = right.select(
        *by, F.col(time).cast(time_type).alias(time), slot(F.col(time)).alias("_slot"), payload.alias("_row"),
        F.struct(*tie).alias("_tie"),
    )
    lhs_cols = left.columns
    lhs = left.select(*by, time, slot(F.col(time)).alias("_slot"), F.struct(*lhs_cols).alias("_left"))

    last_of_slot = rhs.groupBy(*by, "_slot").agg(F.max_by("_row", F.struct(time, "_tie")).alias("_row"))
    asked = lhs.select(*by, "_slot").distinct().withColumn("_ask", F.lit(True))
    earlier = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        asked.join(last_of_slot, [*by, "_slot"], "full")
        .select(*by, "_slot", "_ask", F.last("_row", ignorenulls=True).over(earlier).alias("_carry"))
        .filter("_ask")
        .drop("_ask")
    )
    # A strict comparison puts left rows first at equal time, else last.
    left_side, right_side = (0, 1) if strict else (1, 0)
    both = lhs.withColumn("_side", F.lit(left_side)).unionByName(
        rhs.withColumn("_side", F.lit(right_side)), allowMissingColumns=True
    )
    inside = Window.partitionBy(*by, "_slot").orderBy(time, "_side", F.col("_tie").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    hit = (
        both.withColumn("_near", F.last("_row", ignorenulls=True).over(inside))
        .filter(F.col("_side") == left_side)
        .join(carry, [*by, "_slot"], "left")
        .select("_left", F.coalesce("_near", "_carry").alias("_hit"))
    )
    if ttl_seconds is not None:
        age = F.unix_seconds(F.col(f"_left.{time}").cast("timestamp")) - F.unix_seconds(
            F.col("_hit._seen").cast("timestamp")
        )
        hit = hit.withColumn("_hit", F.when(age <= ttl_seconds, F.col("_hit")))
    return hit.select("_left.*", *[F.col(f"_hit.{c}").alias(c) for c in cols])


def latest_n_asof(
    left: DataFrame, right: DataFrame, by: list[str], day: str, right_day: str, tie: list[str], n: int, lag_days: int = 0
) -> DataFrame:
    """(by, day) asked by left -> its n latest right rows with right_day <= day + lag_days.

    Right rows are numbered inside their key. The number of rows known on a day
    gives the wanted range of n numbers, which touches at most two blocks of n:
    an equi join on (key, block) finds them, so a left key meets at most 2n rows.
    """
    from .history import ranked

    new = ranked(right, by, right_day, tie, "_pos")
    r = earlier_rows(new, by, "_pos", n).drop("_old")
    r = r.withColumn("_block", F.floor((F.col("_pos") - 1) / n).cast("long"))
    # State of the key at the end of each report day: how many rows are known.
    upto = latest(new.groupBy(*by, right_day).agg(F.max("_pos").alias("_known")), by, right_day).withColumnRenamed(right_day, "_d")
    asked = left.select(*by, day).distinct().withColumn("_d", F.date_add(F.col(day), lag_days))
    order = Window.partitionBy(*by).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    known = (
        asked.join(upto, [*by, "_d"], "full")
        .withColumn("_known", F.last("_known", ignorenulls=True).over(order))
        .filter(F.col(day).isNotNull() & F.col("_known").isNotNull())
    )
    last_block = F.floor((F.col("_known") - 1) / n).cast("long")
    probes = known.select(
        *by, day, "_known",
        F.explode(F.when(last_block > 0, F.array(last_block - 1, last_block)).otherwise(F.array(last_block))).alias("_block"),
    )
    hit = probes.join(r.drop("_before", "_in_day"), [*by, "_block"]).filter(
        (F.col("_pos") <= F.col("_known")) & (F.col("_pos") > F.col("_known") - n)
    )
    return hit.drop("_block", "_known", "_pos")
