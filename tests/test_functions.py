from pyspark.sql import functions as F

from foretally.functions.numeric import half_up, rounded
from foretally.functions.text import duration_text, minutes_played, season_label


def test_minutes(spark):
    rows = [("PT32M45S",), ("PT05M30.00S",), ("36:00",), ("",), (None,), ("12.5",), ("PT1H2M",), ("abc",)]
    got = [r.m for r in spark.createDataFrame(rows, "t string").select(minutes_played("t").alias("m")).collect()]
    assert got == [32.75, 5.5, 36.0, 0.0, 0.0, 12.5, 62.0, 0.0]


def test_half_up(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (0.125,), (2.5,), (-0.0000001,), (None,), (5e9,)], "x double")
    got = [r.y for r in df.select(half_up("x", 2).alias("y")).collect()]
    assert got == [1.01, -1.01, 0.13, 2.5, 0.0, None, 5e9]
    assert [r.x for r in rounded(df, 2).collect()] == got


def test_season_and_duration(spark):
    df = spark.createDataFrame([("2024-10-01", 32.75), ("2000-01-05", 7.0)], "d string, m double")
    got = df.select(season_label(F.col("d").cast("date")).alias("s"), duration_text("m").alias("t")).collect()
    assert [(r.s, r.t) for r in got] == [("2024-25", "PT32M45S"), ("1999-00", "PT7M0S")]
