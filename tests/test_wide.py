"""Wide tables: how they are written, and joined in the order of their files."""

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from foretally.plans import assembly, registry
from foretally.plans.registry import WIDE, Models, write_table


def games(spark, n=500):
    return spark.range(n).select(
        F.when(F.col("id") % 50 > 0, F.col("id")).alias("game_id"), F.lit("2020-01-01").cast("date").alias("game_date"), F.lit(1).alias("home_team_id"),
        F.lit(2).alias("away_team_id"), F.lit(1).alias("home_score"), F.lit(0).alias("away_score"))


def test_written_pieces_are_joined_without_sorting_them_again(spark):
    m = Models(spark, {"stg_games": games(spark)})
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = [m.games.select("game_id", (F.col("game_id") % k).alias(f"f{k}")).where("game_id is not null").repartition(3) for k in range(2, 9)]
        out = assembly.join_on_game(m, parts)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and "Sort [" not in plan and "Exchange" not in plan
        assert out.count() == 500 and out.where("f7 <> coalesce(game_id % 7, 0) or f2 <> coalesce(game_id % 2, 0)").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        m.close()


def test_only_wide_tables_go_without_dictionaries(spark, tmp_path):
    for width, plain in ((WIDE - 1, False), (WIDE, True)):
        df = spark.range(300).select(*[(F.col("id") % 5).cast("double").alias(f"c{i}") for i in range(width)])
        assert write_table(df, spark, f"w{width}", str(tmp_path)).exceptAll(df).count() == 0
        file = next(Path(tmp_path).glob(f"w{width}-*/*.parquet"))
        used = pq.ParquetFile(file).metadata.row_group(0).column(0)
        assert (used.has_dictionary_page, used.compression) == ((False, "ZSTD") if plain else (True, "SNAPPY"))


FIRST, ADVISED = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_a_task_gets_no_more_rows_when_tables_grow(spark):
    """Parts are joined up to the advised size only, however few shuffle partitions the session asks for."""
    before = {k: spark.conf.get(k, None) for k in (FIRST, ADVISED)}
    spark.conf.unset(FIRST)
    spark.conf.set(ADVISED, "1m")
    try:
        Models(spark, {"stg_games": games(spark)})
        n = [spark.range(rows).select(F.xxhash64("id").alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("b")).repartition("a").rdd.getNumPartitions() for rows in (200_000, 600_000)]
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) < n[0] < n[1] <= registry.PARTS
        spark.conf.set(FIRST, "7")
        Models(spark, {"stg_games": games(spark)})
        assert spark.conf.get(FIRST) == "7"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_shuffled_beside_buckets_move_once(spark):
    m = Models(spark, {"stg_games": games(spark)})
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys, first = m["game_keys"], spark.conf.get(FIRST)
        with registry.parts_like_buckets(spark):
            plan = keys.join(m.games.groupBy("game_id").agg(F.count("*")), "game_id", "left")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hash") == 1 and spark.conf.get(FIRST) == first
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        m.close()
