"""Incremental loads: files that arrive later are added by a stream with its own checkpoint (an extension of resumable loads)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import duplicates, encode
from ..plans.ddl import TableSpec


def load_available(spark: SparkSession, source: str, spec: TableSpec, target: str, checkpoint: str, strict: bool = True, task_time: str = "1970-01-01 00:00:00") -> None:
    """Encodes the Parquet files below source that earlier calls have not seen, and appends them to target, each file once.

    Every micro-batch goes to a folder of its own, written over if a failed one is run again, so that a restart neither
    loses nor repeats rows.
    """
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)

    def put(batch: DataFrame, number: int) -> None:
        rows = batch.select((F.lit(number).cast("long") * (1 << 40) + F.monotonically_increasing_id()).alias(encode.ROW_ID), *[F.col(f"`{c}`").alias(c.lower()) for c in batch.columns])
        encode.encode(rows, spec, strict=strict, source_columns=[c.lower() for c in batch.columns], task_time=task_time).write.mode("overwrite").parquet(f"{target}/load={number}")

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def loaded(spark: SparkSession, target: str, keys: list[str] | None = None, policy: str = "replace") -> DataFrame:
    """What has been loaded so far, with duplicate keys over all loads resolved."""
    rows = spark.read.option("basePath", target).parquet(target).drop("load")
    return duplicates.resolve(rows, keys, policy) if keys else rows
