"""Tables laid out by hash parts and buckets: what a write or a join leaves alone."""

from pathlib import Path

from pyspark.sql import functions as F

from foretally import catalog  # noqa: F401  (registers the models)
from foretally.operators import merge
from foretally.plans import assembly
from foretally.plans.registry import Models
from foretally.plans.views import staging_from_star

from .conftest import SF


def files(path):
    out = {}
    for f in Path(path).glob("key_part=*/*.parquet"):
        out.setdefault(f.parent.name, set()).add(f.name)
    return out


def test_upsert_leaves_untouched_parts_alone(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, v string, n int, part string"
    first = spark.createDataFrame([(i, "a", 1, "x") for i in range(200)], schema)
    merge.upsert_parts(spark, path, first, ["k"], ["n"], parts=16)
    before = files(path)
    batch = spark.createDataFrame([(3, "b", 2, "y"), (3, "c", 3, "y"), (500, "d", 2, "y")], schema)
    for _ in range(2):  # run again, the same table
        merge.upsert_parts(spark, path, batch, ["k"], ["n"], parts=16)
        got = {r.k: (r.v, r.n, r.part) for r in merge.read_parts(spark, path, schema).collect()}
        assert got == {**{i: ("a", 1, "x") for i in range(200)}, 3: ("c", 3, "y"), 500: ("d", 2, "y")}
        assert merge.read_parts(spark, path, schema).count() == 201
    touched = {f"key_part={r[0]}" for r in batch.select(F.pmod(F.xxhash64("k"), F.lit(16))).distinct().collect()}
    after = files(path)
    assert all((before[p] == after[p]) == (p not in touched) for p in before)
    merge.upsert_parts(spark, path, batch.limit(0), ["k"], ["n"], parts=16)
    assert files(path) == after


def test_append_adds_files_only(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, v string, n int"
    merge.upsert_parts(spark, path, spark.createDataFrame([(i, "a", 1) for i in range(50)], schema), ["k"], ["n"], 8, add_only=True)
    before = files(path)
    batch = spark.createDataFrame([(3, "b", 9), (77, "c", 1), (77, "d", 2)], schema)
    for _ in range(2):
        merge.upsert_parts(spark, path, batch, ["k"], ["n"], 8, add_only=True)
        got = {r.k: r.v for r in merge.read_parts(spark, path, schema).collect()}
        assert got == {**dict.fromkeys(range(50), "a"), 77: "d"}
    assert all(before[p] <= names for p, names in files(path).items() if p in before)


def test_pieces_of_a_feature_group_are_joined_without_moving_rows(spark):
    m = Models(spark, staging_from_star(spark, SF))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = [m.games.select("game_id", (F.col("game_id") % k).alias(f"f{k}")) for k in range(2, 9)]
        out = assembly.join_on_game(m, parts)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert out.filter("f7 <> game_id % 7 or f2 <> game_id % 2").count() == 0 and out.count() == m.games.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        m.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("foretally_piece")]
