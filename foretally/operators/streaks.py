"""Runs of equal state, seen from the row that follows them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .carry import active

_START = Window.unboundedPreceding


def streak_before(
    df: DataFrame, by: list[str], day: str, tie: list[str], state: str, measures: dict[str, Column] | None = None
) -> DataFrame:
    """Add the streak that ended with the entity's previous row.

    Adds `streak_state`, `streak_len` and one `streak_<measure>` sum per measure
    (NULL on the first row). Runs are built inside each (entity, day) group; a
    day is then summarised as its closing run plus whether it was one single
    run, and closing runs are chained over the day table. No task holds more
    than one day of facts or one row per day.
    """
    measures = measures or {}
    in_day = Window.partitionBy(*by, day).orderBy(*tie)
    st = F.col(state)
    rows = df.withColumn("_prev", F.lag(state).over(in_day)).withColumn("_i", F.row_number().over(in_day))
    rows = rows.withColumn(
        "_run", F.sum(F.when((F.col("_i") > 1) & ~F.col("_prev").eqNullSafe(st), 1).otherwise(0)).over(
            in_day.rowsBetween(_START, 0))
    )
    in_run = Window.partitionBy(*by, day, "_run").orderBy(*tie).rowsBetween(_START, 0)
    sums = {"len": F.lit(1).cast("long"), **measures}
    rows = rows.select("*", *[F.sum(c).over(in_run).alias(f"_at_{n}") for n, c in sums.items()])

    closing = rows.groupBy(*by, day).agg(
        F.max_by(F.struct(st.alias("state"), F.col("_run").alias("run"), *[F.col(f"_at_{n}").alias(n) for n in sums]), "_i").alias("c")
    )
    history = active()
    name, ended = history.call() if history else ("", None)
    if ended is not None:
        closing = closing.unionByName(ended.select(closing.columns))
    days = Window.partitionBy(*by).orderBy(day)
    chain = closing.select(*by, day, "c", F.lag("c.state").over(days).alias("_ps"), F.lag("c.run").over(days).alias("_pr"))
    # A day continues the chain when it is one run of the state the day before closed with.
    joins_on = (F.col("c.run") == 0) & F.col("_pr").isNotNull() & F.col("c.state").eqNullSafe(F.col("_ps"))
    chain = chain.withColumn("_seg", F.sum(F.when(joins_on, 0).otherwise(1)).over(days.rowsBetween(_START, 0)))
    seg = Window.partitionBy(*by, "_seg").orderBy(day).rowsBetween(_START, 0)
    chain = chain.select(
        *by, day, F.struct(F.col("c.state").alias("state"), *[F.sum(f"c.{n}").over(seg).alias(n) for n in sums]).alias("_end")
    )
    if history:
        # the run each entity is in, as a day that was one single run
        last = chain.groupBy(*by).agg(F.max(day).alias(day), F.max_by("_end", day).alias("_e"))
        kinds = closing.schema["c"].dataType
        history.keep(name, last.select(*by, day, F.struct(F.col("_e.state").alias("state"), F.lit(0).alias("run"), *[F.col(f"_e.{n}").alias(n) for n in sums]).cast(kinds).alias("c")))
    carry = chain.select(*by, day, F.lag("_end").over(days).alias("_carry"))

    here = F.lag(
        F.struct(st.alias("state"), F.col("_run").alias("run"), *[F.col(f"_at_{n}").alias(n) for n in sums])
    ).over(in_day)
    out = rows.withColumn("_here", here).join(carry, [*by, day], "left")
    first = F.col("_i") == 1
    through = (F.col("_here.run") == 0) & F.col("_carry").isNotNull() & F.col("_here.state").eqNullSafe(F.col("_carry.state"))

    def pick(n):
        return (
            F.when(first, F.col(f"_carry.{n}"))
            .when(through, F.col(f"_carry.{n}") + F.col(f"_here.{n}"))
            .otherwise(F.col(f"_here.{n}"))
        )

    return out.select(
        *df.columns,
        F.when(first, F.col("_carry.state")).otherwise(F.col("_here.state")).alias("streak_state"),
        *[pick(n).alias(f"streak_{n}") for n in sums],
    )
