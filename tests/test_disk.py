"""What a graph leaves on disk, and models built at the same time."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foretally.plans import assembly, registry
from foretally.plans.registry import Models

from .test_wide import games

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture
def models(monkeypatch):
    """Registers models for one test."""
    for name in ("_BUILDERS", "_TABLES"):
        monkeypatch.setattr(registry, name, dict(getattr(registry, name)))
    return registry.model


def test_a_group_is_written_once_as_its_pieces(spark):
    m = Models(spark, {"stg_games": games(spark).where("game_id is not null")})
    try:
        for n in (3, 7):
            got = assembly.join_on_game(m, [m.games.select("game_id", (F.col("game_id") % k).alias(f"f{k}")) for k in range(2, 2 + n)])
            assert got.count() == 490 and got.where(f"f{n + 1} <> game_id % {n + 1}").count() == 0
        names = [p.name for p in Path(m._root.removeprefix("file:")).iterdir()]
        assert sum("piece" in x for x in names) == 1 + 3 and len(names) == 5  # and the keys
        assert not any(registry._TABLES.get(g) for g in assembly.GROUPS)
    finally:
        m.close()


def test_shuffle_files_go_when_a_table_is_written(spark, tmp_path):
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def kept():
        return {b.toString() for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.diskBlockManager().getAllBlocks()) if b.toString().startswith("shuffle_")}

    before, first = kept(), spark.conf.get(CLEANUP, None)
    assert registry.write_table(rows, spark, "t", str(tmp_path)).count() == 10
    made_by_read = kept() - before  # the count itself shuffles one row a task
    assert spark.conf.get(CLEANUP, None) == first
    rows.write.parquet(str(tmp_path / "plain"))
    assert len(kept() - before - made_by_read) > 0
    here = kept()
    registry.write_table(rows, spark, "t", str(tmp_path))
    assert kept() <= here


def test_models_are_built_at_the_same_time_and_once(spark, models):
    met, made = threading.Barrier(2, timeout=60), []

    @models("shared_part", table=True)
    def shared_part(m):
        made.append("shared_part")
        return m.games.select("game_id")

    for name in ("left_part", "right_part"):
        @models(name)
        def part(m, name=name):
            met.wait()  # passes only if both are being built
            made.append(name)
            return m["shared_part"].select("game_id", F.lit(name).alias(name))

    m = Models(spark, {"stg_games": games(spark)})
    first = spark.conf.get(registry._FIRST_PARTS, None)
    try:
        m.together(["left_part", "right_part"])
        assert sorted(made) == ["left_part", "right_part", "shared_part"]
        assert m["left_part"].count() == m["right_part"].count() == 500 and len(made) == 3
        assert spark.conf.get(registry._FIRST_PARTS, None) == first
    finally:
        m.close()


def test_a_setting_is_held_until_its_last_block_ends(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    a, b = registry.one_key_enough(spark), registry.one_key_enough(spark)
    a.__enter__()
    b.__enter__()
    a.__exit__(None, None, None)
    assert spark.conf.get(key) == "false"
    b.__exit__(None, None, None)
    assert spark.conf.get(key, None) == before



def test_wide_tables_are_joined_as_structs(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "game_id long, x string")
    one = spark.createDataFrame([(1, 1, 10.0), (2, 2, None), (2, 3, 30.0), (None, 4, 40.0)], "game_id long, p int, q double")
    two = spark.createDataFrame([(1, True), (9, False)], "game_id long, r boolean")
    got = assembly.beside(left, [one, two])
    want = left.join(one, "game_id", "left").join(two, "game_id", "left")
    assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() == 6
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in plan.splitlines() if "Project" in line]
    assert joined and "AS x#" in joined[0] and "AS q#" in joined[0] and not any("AS x#" in line or "AS q#" in line for line in joined[1:])
