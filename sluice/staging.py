"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession) -> str:
    """A new path below the shared folder that the cluster names in spark.checkpoint.dir.

    Where that is unset, a local session gets a temporary folder; on a cluster, whose machines share none, it is an error.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/sluice-{uuid.uuid4().hex}"


def written(df: DataFrame, **options: object) -> DataFrame:
    """df as a Parquet table in the shared folder: evaluated once, its lineage cut, and safe from lost executors.

    The files go when the driver's JVM ends.  The shuffles of the write go at its end, not when the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def with_totals_before(df: DataFrame, order: list[str], **sizes: Column) -> DataFrame:
    """df with, for each name, the total of its size over all rows before the row in order; no task sees all rows.

    Rows are dealt to key ranges, summed within these and shifted by the totals of the ranges before.  The bounds of the
    ranges come from samples and differ from one evaluation to the next, so the dealt rows are written before they are read twice.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumns({f"__{n}": size for n, size in sizes.items()}).repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id())
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = written(dealt.withColumns({n: F.coalesce(F.sum(f"__{n}").over(inside), F.lit(0)) for n in sizes}))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    sums = rows.groupBy("__range").agg(*[F.sum(f"__{n}").alias(f"__{n}") for n in sizes])
    shift = sums.select("__range", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__before_{n}") for n in sizes])
    placed = rows.join(F.broadcast(shift), "__range").withColumns({n: F.col(n) + F.col(f"__before_{n}") for n in sizes})
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], *sizes)
