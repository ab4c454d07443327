"""Table input and output: CSV with header, relational databases, parquet by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def export_csv(df: DataFrame, path: str) -> None:
    """Write with header; one file per task, so a large table is written in parallel."""
    df.write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with a given schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def load_csv(spark: SparkSession, path: str, schema: T.StructType, target: str, truncate: bool = False) -> None:
    """Import a CSV folder into a parquet table, replacing or extending it."""
    import_csv(spark, path, schema).write.mode("overwrite" if truncate else "append").parquet(target)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: str, upper: str, parts: int = 64, **options) -> DataFrame:
    """Partitioned read: the range of a numeric or date column is split over tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("partitionColumn", column)
    return reader.option("lowerBound", lower).option("upperBound", upper).option("numPartitions", parts).options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", parts: int = 16, **options) -> None:
    """Write with a bounded number of connections."""
    df.coalesce(parts).write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", 10_000).options(**options).mode(mode).save()
