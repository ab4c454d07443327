"""Profiles, drift, anomalies and freshness of tables and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import ratio, with_scalars
from ..operators.history import Measure, attach, prior_days


def sample_of(df: DataFrame, share: float, key: list[str]) -> DataFrame:
    """Repeatable sample: rows whose key hash falls below the share."""
    return df if share >= 1 else df.filter(F.pmod(F.xxhash64(*key), F.lit(1_000_000)) < int(share * 1_000_000))


def profile(df: DataFrame, columns: list[str] | None = None, exact_distinct: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct, min, max, mean, stddev; a single pass."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for f in fields:
        c = F.col(f.name)
        num = isinstance(f.dataType, T.NumericType)
        distinct = F.count_distinct(c) if exact_distinct else F.approx_count_distinct(c)
        aggs.append(F.struct(
            F.lit(f.name).alias("column_name"), F.count_if(c.isNull()).alias("nulls"), distinct.alias("distinct_values"),
            F.min(c).cast("string").alias("min_value"), F.max(c).cast("string").alias("max_value"),
            (F.avg(c) if num else F.lit(None).cast("double")).alias("mean"),
            (F.stddev_samp(c) if num else F.lit(None).cast("double")).alias("stddev")).alias(f"_c_{f.name}"))
    one = df.agg(*aggs)
    return one.select(F.col("_rows").alias("rows"), F.explode(F.array(*[F.col(f"_c_{f.name}") for f in fields])).alias("x")).select("rows", "x.*")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between minimum and maximum; two passes over one column."""
    v = F.col(column).cast("double")
    edge = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(F.least(F.floor((v - F.col("_lo")) / width), F.lit(bins - 1)))
    rows = with_scalars(df.filter(F.col(column).isNotNull()).select(column), edge)
    return rows.select(b.cast("int").alias("bin"), (F.col("_lo") + b * width).alias("bin_start")).groupBy("bin").agg(
        F.min("bin_start").alias("bin_start"), F.count(F.lit(1)).alias("n"))


# Percent change from which a drift is low, medium, high.
DRIFT_BANDS = (5.0, 15.0, 30.0)


def drift(baseline: DataFrame, current: DataFrame, key: str = "column_name", metrics: tuple[str, ...] = ("mean", "nulls", "distinct_values"), bands=DRIFT_BANDS) -> DataFrame:
    """Percent change of each metric between two profiles, with its band."""
    def long(df, name):
        items = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(name)) for m in metrics])
        return df.select(key, F.explode(items).alias("x")).select(key, "x.*")

    both = long(baseline, "before").join(long(current, "after"), [key, "metric"], "full")
    change = F.abs(ratio((F.col("after") - F.col("before")) * 100.0, F.abs("before")))
    change = F.when((F.col("before") == 0) & (F.col("after") != 0), F.lit(100.0)).when((F.col("before") == 0) & (F.col("after") == 0), F.lit(0.0)).otherwise(change)
    low, mid, high = bands
    band = F.when(F.col("change_pct") >= high, "high").when(F.col("change_pct") >= mid, "medium").when(F.col("change_pct") >= low, "low").otherwise("none")
    return both.withColumn("change_pct", change).withColumn("severity", F.when(F.col("change_pct").isNotNull(), band))


def _band(v: Column, mid: Column, spread: Column, k: float) -> Column:
    return F.coalesce(F.abs(v - mid) > k * spread, F.lit(False))


def anomalies(metrics: DataFrame, by: list[str], day: str, value: str, days: int = 30, least: int = 5) -> DataFrame:
    """Flags of four methods against the values of the `days` days before.

    The input holds one metric value per key and day, so a window keeps at most
    `days` values: control limits (mean +- 3 sd), quartile fences (1.5 IQR),
    median distance (3.5 scaled MAD) and an exponentially weighted mean.
    """
    order = Window.partitionBy(*by).orderBy(F.unix_date(F.col(day))).rangeBetween(-days, -1)
    hist = metrics.withColumn("_h", F.array_sort(F.collect_list(F.col(value).cast("double")).over(order))).withColumn(
        "_recent", F.collect_list(F.struct(F.col(day).alias("d"), F.col(value).cast("double").alias("v"))).over(order))
    v = F.col(value).cast("double")
    n = F.size("_h")

    def quantile(arr: Column, q: float) -> Column:
        # Linear interpolation on a sorted array of at most `days` values.
        pos = (F.size(arr) - 1) * F.lit(q)
        lo = F.floor(pos).cast("int")
        a, b = F.get(arr, lo), F.get(arr, F.least(lo + 1, F.size(arr) - 1))
        return a + (b - a) * (pos - lo)

    mean = ratio(F.aggregate("_h", F.lit(0.0), lambda s, x: s + x), n)
    h = hist.withColumn("_n", n).withColumn("_mean", mean)
    ss = F.aggregate("_h", F.lit(0.0), lambda s, x: s + (x - F.col("_mean")) * (x - F.col("_mean")))
    h = h.withColumn("_sd", F.sqrt(ratio(ss, F.col("_n") - 1))).withColumn("_q1", quantile(F.col("_h"), 0.25)).withColumn("_q3", quantile(F.col("_h"), 0.75)).withColumn("_med", quantile(F.col("_h"), 0.5))
    h = h.withColumn("_mad", quantile(F.array_sort(F.transform("_h", lambda x: F.abs(x - F.col("_med")))), 0.5))
    # Weights 0.3 * 0.7^k by age in values; the list is ordered by day.
    ewma = F.aggregate("_recent", F.lit(None).cast("double"), lambda acc, x: F.when(acc.isNull(), x.v).otherwise(0.7 * acc + 0.3 * x.v))
    h = h.withColumn("_ew", ewma)
    ready = F.col("_n") >= least
    iqr = F.col("_q3") - F.col("_q1")
    return h.select(
        *by, day, value, F.col("_n").alias("history"),
        (ready & _band(v, F.col("_mean"), F.col("_sd"), 3.0)).alias("control_limits"),
        (ready & F.coalesce((v < F.col("_q1") - 1.5 * iqr) | (v > F.col("_q3") + 1.5 * iqr), F.lit(False))).alias("iqr"),
        (ready & _band(v, F.col("_med"), F.col("_mad") * 1.4826, 3.5)).alias("mad"),
        (ready & _band(v, F.col("_ew"), F.col("_sd"), 3.0)).alias("ewma"))


def freshness(df: DataFrame, time: str, now: Column, hours: int = 24) -> DataFrame:
    """Age of the newest row and whether it is within the limit; an empty table is not available."""
    age = F.timestamp_diff("SECOND", F.max(time).cast("timestamp_ntz"), now.cast("timestamp_ntz")) / 3600.0
    return df.agg(F.count(F.lit(1)).alias("rows"), F.max(time).alias("newest"), age.alias("age_hours")).select(
        "*", F.coalesce(F.col("age_hours") <= hours, F.lit(False)).alias("is_fresh"), (F.col("rows") > 0).alias("is_available"))
