"""Helpers shared by the operators: scratch tables, row keys, global running totals, local union-find."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word: a run of characters other than blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITTEN: list[str] = []


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with columns named by their place, and the new name of each: added columns cannot clash with them."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; only a local master may go without the setting."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file:/tmp/foretally-scratch"


def stored(df: DataFrame) -> DataFrame:
    """The rows of `df`, written as Parquet to the shared folder and read again: lineage ends here, files survive lost
    executors, and the optimizer knows their size."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/foretally-llm/{uuid.uuid4().hex}"
    with shuffle_files_removed(spark):
        df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete every table that `stored` wrote from this process; call it when no result of these operators is needed."""
    n = len(_WRITTEN)
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Shuffle files go as soon as the job in this block has ended, not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def spread_bits(*names: str) -> Column:
    """60 uniform bits of the named columns."""
    return F.xxhash64(*names).bitwiseAND(F.lit((1 << 60) - 1))


def limit_for(wanted: int, rows: int) -> int:
    """The bound on `spread_bits` below which about `wanted` of `rows` rows lie, however many there are."""
    return min(1 << 60, (wanted << 60) // max(1, rows))


def running_totals(df: DataFrame, order: Sequence[str | Column], sums: Sequence[str]) -> DataFrame:
    """Adds `before_<s>` for each s in `sums`: the total over all rows earlier in `order`. `order` must tell rows apart.

    Rows are range-partitioned; only one row of totals per partition is brought together, so no task sees all rows.
    """
    parts = stored(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    totals = parts.groupBy("_p").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select("_p", *[F.coalesce(F.sum(f"_t_{s}").over(earlier), F.lit(0)).alias(f"_o_{s}") for s in sums])
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = parts.select("*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_w_{s}") for s in sums])
    out = out.join(start, "_p")
    return out.select(*df.columns, *[(F.col(f"_o_{s}") + F.col(f"_w_{s}")).alias(f"before_{s}") for s in sums])


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and edges a-b: the smallest node of each node's component (minimum labels with pointer jumps)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new
