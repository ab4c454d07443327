"""Column helpers for text: playing time, names, status words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col


def minutes_played(c: str | Column) -> Column:
    """Minutes as double from `PT32M45S`, `PT05M30.00S`, `36:00` or a plain number.

    NULL and text of no known form give 0.
    """
    c = F.trim(col(c))
    iso = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?$"

    def part(pattern, i):
        return F.coalesce(F.regexp_extract(c, pattern, i).try_cast("double"), F.lit(0.0))

    clock = r"^(\d+):(\d+(?:\.\d+)?)$"
    return F.coalesce(
        F.when(c.rlike(iso), part(iso, 1) * 60 + part(iso, 2) + part(iso, 3) / 60)
        .when(c.rlike(clock), part(clock, 1) + part(clock, 2) / 60)
        .otherwise(c.try_cast("double")),
        F.lit(0.0),
    )


def duration_text(minutes: str | Column) -> Column:
    """Numeric minutes to `PTxMyS`; NULL stays NULL."""
    m = col(minutes).cast("double")
    whole = F.floor(m)
    secs = F.floor((m - whole) * 60)
    return F.when(
        m.isNotNull(), F.concat(F.lit("PT"), whole.cast("string"), F.lit("M"), secs.cast("string"), F.lit("S"))
    )


def name_key(c: str | Column) -> Column:
    """Join key for person names: case and outer blanks do not count."""
    return F.upper(F.trim(col(c)))


def full_name(first: str | Column, last: str | Column) -> Column:
    """Two name parts joined by one blank; missing parts leave no blank behind."""
    return F.trim(F.concat_ws(" ", F.coalesce(col(first), F.lit("")), F.coalesce(col(last), F.lit(""))))


def season_label(day: Column) -> Column:
    """`2023-24` style season of a date; a season starts in October."""
    start = F.when(F.month(day) >= 10, F.year(day)).otherwise(F.year(day) - 1)
    return F.concat(start.cast("string"), F.lit("-"), F.lpad(F.pmod(start + 1, F.lit(100)).cast("string"), 2, "0"))
