"""Keyed writes as micro-batches: the batch jobs with an available-now trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import read_parts, upsert_parts


def stream_into(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: list[str], order: list[str], mode: str = "upsert", parts: int = 64,
) -> StreamingQuery:
    """Read newly landed parquet files once and merge each micro-batch into the target table.

    The table is laid out in `parts` folders by a hash of the key. A batch rewrites the folders it has keys for ("upsert") or
    adds files with its new keys ("append"); run twice it gives the same table, as a retried batch must.
    """
    add_only = {"upsert": False, "append": True}[mode]

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_parts(batch.sparkSession, target, batch, key, order, parts, add_only)

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(source)
    return reader.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The streamed table."""
    return read_parts(spark, target, schema)
