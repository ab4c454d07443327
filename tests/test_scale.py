"""Code length and aggregation by hashing: what decides time on larger tables."""

import datetime as dt
import math

from pyspark.sql import functions as F

from foretally.functions.numeric import half_up, half_up_sql, rounded
from foretally.operators.asof import asof_day
from foretally.plans.registry import Models

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_models_have_long_methods_split_unless_the_session_says_otherwise(spark):
    spark.conf.unset(LIMIT)
    Models(spark, {})
    assert spark.conf.get(LIMIT) == "8000"
    spark.conf.set(LIMIT, "20000")
    Models(spark, {})
    assert spark.conf.get(LIMIT) == "20000"
    spark.conf.unset(LIMIT)


def test_rounding_text_names_its_column_four_times_and_rounds_as_the_column_does(spark):
    assert half_up_sql("`v`", 2).count("`v`") == 4
    df = spark.createDataFrame([(x,) for x in (-1.005, 1.005, -0.0, 0.0, -0.001, 2e9 + 0.125, -2e9 - 0.125, 0.125, -0.125, float("nan"), float("inf"), None)], "v double")
    got, want = [r.v for r in rounded(df, 2).collect()], [r.y for r in df.select(half_up("v", 2).alias("y")).collect()]
    assert [repr(v) for v in got] == [repr(v) for v in want]
    assert all(math.copysign(1, v) == 1 for v in got[2:5])


def test_newest_row_of_a_day_is_found_without_sorting_rows(spark):
    day = dt.date(2024, 1, 1)
    rows = [(e, day + dt.timedelta(days=n // 3), n, n, None if n % 4 == 2 else n * 0.5) for e in (1, None) for n in range(12)]
    right = spark.createDataFrame(rows, "e int, day date, id long, n long, x double")
    left = spark.createDataFrame([(i, e, day + dt.timedelta(days=i)) for e in (1, 2, None) for i in range(6)], "k int, e int, day date")
    args = (left, right, ["e"], "day", ["x", "n"], ["id"])
    plain, hashed = asof_day(*args), asof_day(*args, place="n")
    assert "SortAggregate" in plan(plain) and "SortAggregate" not in plan(hashed)
    assert sorted(map(str, hashed.collect())) == sorted(map(str, plain.collect()))
