"""Key ranges: sorting and splitting by key, size histograms, chunks by bytes, key-value pairs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import with_totals_before

RANGE_BYTES, RANGE_KEYS = 96 << 20, 960_000
STEP_BYTES, STEP_KEYS = 4 << 20, 40 << 10


def range_count(total_bytes: int, total_keys: int, range_bytes: int = RANGE_BYTES, range_keys: int = RANGE_KEYS) -> int:
    return max(1, math.ceil(total_bytes / range_bytes), math.ceil(total_keys / range_keys))


def range_sorted(df: DataFrame, keys: list[str], total_bytes: int | None = None, total_keys: int | None = None) -> DataFrame:
    """df in partitions by ranges of the keys, sorted within; as many as the sizes ask for."""
    if total_bytes is None or total_keys is None:
        total_keys, total_bytes = df.agg(F.count("*"), F.coalesce(F.sum(sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0))), F.lit(0))).first()
    by = [F.col(f"`{k}`") for k in keys]
    return df.repartitionByRange(range_count(total_bytes, total_keys), *by).sortWithinPartitions(*by)


def histogram(df: DataFrame, key: str, size: Column, step_bytes: int = STEP_BYTES, step_keys: int = STEP_KEYS) -> DataFrame:
    """(bucket, low, high, n_keys, n_bytes): buckets of successive keys, each at most step_keys keys and about step_bytes bytes long.

    Running totals are taken within key ranges and shifted by the totals of the ranges before, so no single task sees all rows.
    """
    per_key = df.groupBy(F.col(f"`{key}`").alias("k")).agg(F.sum(size).alias("b"), F.count("*").alias("n"))
    placed = with_totals_before(per_key, ["k"], bytes_before=F.col("b"), keys_before=F.col("n"))
    placed = placed.withColumn("bucket", F.greatest(F.floor(F.col("bytes_before") / step_bytes), F.floor(F.col("keys_before") / step_keys)))
    return placed.groupBy("bucket").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.sum("n").alias("n_keys"), F.sum("b").alias("n_bytes"))


def byte_chunks(df: DataFrame, order: str, size: Column, limit: int) -> DataFrame:
    """df with chunk: rows in order are cut into chunks of about limit bytes (by the running total before each row)."""
    placed = with_totals_before(df, [order], bytes_before=size)
    return placed.withColumn("chunk", F.floor(F.col("bytes_before") / limit)).drop("bytes_before")


def key_values(df: DataFrame, primary: list[str], indexes: dict[str, list[str]]) -> DataFrame:
    """(kind, key, value): a row pair ``r`` and one pair ``i`` for each index, from each row."""
    text = lambda cols: F.concat_ws("\x01", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in cols])
    pair = lambda kind, name, key, value: F.struct(F.lit(kind).alias("kind"), F.concat(F.lit(f"{kind}{name}\x02"), key).alias("key"), value.alias("value"))
    row = pair("r", "", text(primary), text([c for c in df.columns if c not in primary]))
    own = [pair("i", name, F.concat(text(cols), F.lit("\x01"), text(primary)), F.lit("0")) for name, cols in indexes.items()]
    return df.select(F.inline(F.array(row, *own)))
