"""Column helpers for numbers: null-safe ratios, defaults and decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up_sql(c: str, digits: int) -> str:
    """Expression text of `half_up`, short because wide tables hold it once per column (`+ 0D` keeps a zero without sign)."""
    step = 10 ** (9 - digits)
    k = f"((floor(abs({c}) * 1e9D + 0.5D) + {step // 2}L) div {step}L)"
    return f"(case when abs({c}) >= 1e9D then round({c}, {digits}) else signum({c}) * {k} / {10**digits}D + 0D end)"


def half_up(c: str | Column, digits: int) -> Column:
    """Round half away from zero, as NUMERIC does, with ties taken on nine decimals.

    Nine decimals remove binary noise (1.005 is stored as 1.00499...), so a value
    rounds the same way whatever order it was summed in. The work is long
    arithmetic inside generated code; from 1e9 on a double holds no ninth decimal,
    and its own decimal digits are rounded half up.
    """
    x = col(c).cast("double")
    step = 10 ** (9 - digits)
    k = F.call_function("div", F.floor(F.abs(x) * 1e9 + 0.5) + F.lit(step // 2).cast("long"), F.lit(step).cast("long"))
    scaled = F.when(x < 0, -k).otherwise(k) / float(10**digits)
    return F.when(F.abs(x) >= 1e9, F.round(x, digits)).otherwise(scaled)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def nvl(c: str | Column, default) -> Column:
    return F.coalesce(col(c), F.lit(default))


def flag(cond: Column) -> Column:
    """1 when the condition holds, 0 when it is false or NULL."""
    return F.when(cond, 1).otherwise(0)


def clip(c: str | Column, lo, hi) -> Column:
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate (league medians, last day) to every row.

    The aggregate has no grouping keys, so it has exactly one row whatever the
    input size; sending that row to all tasks is a broadcast of proven size.
    """
    return df.crossJoin(F.broadcast(one_row))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, for results that are compared or published."""
    real = (T.DoubleType, T.FloatType)
    return df.selectExpr(*[
        f"{half_up_sql(f'`{f.name}`', digits)} as `{f.name}`" if isinstance(f.dataType, real) else f"`{f.name}`" for f in df.schema.fields
    ])
