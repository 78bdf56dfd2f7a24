"""Rows as multi-row SQL statements for a database, and their delivery over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sqltext import identifier, table_name, tuple_literal

MAX_BYTES = 1 << 20
VERBS = {"replace": "REPLACE INTO", "ignore": "INSERT IGNORE INTO", "error": "INSERT INTO"}


def statements(df: DataFrame, schema: str, table: str, policy: str = "replace", order: list[str] | None = None, max_bytes: int = MAX_BYTES, backslash_escapes: bool = True) -> DataFrame:
    """(chunk, n_rows, statement): statements of about max_bytes each, the rows of a partition in order.

    A statement is cut by the running total of its rows' bytes within a partition, so none gathers more than max_bytes and one row.
    """
    names = ",".join(identifier(c) for c in df.columns)
    rows = df.select(tuple_literal(df.dtypes, backslash_escapes).alias("row"), *[F.col(identifier(c)).alias(f"o{k}") for k, c in enumerate(order or [])], F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("nth"))
    by = [*(f"o{k}" for k in range(len(order or []))), "nth"]
    before = F.coalesce(F.sum(F.octet_length("row") + 1).over(Window.partitionBy("p").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("part", F.floor(before / max_bytes)).withColumn("nth", F.struct(*by))
    grouped = rows.groupBy("p", "part").agg(F.count("*").alias("n_rows"), F.array_sort(F.collect_list(F.struct("nth", "row"))).alias("rows"))
    text = F.concat(F.lit(f"{VERBS[policy]} {table_name(schema, table)} ({names}) VALUES "), F.concat_ws(",", F.col("rows.row")), F.lit(";"))
    return grouped.select(F.concat_ws("-", "p", "part").alias("chunk"), "n_rows", text.alias("statement"))


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Appends rows over JDBC; tasks that fail are run again by Spark, so the table needs a key and the statements a policy that allow it."""
    df.write.format("jdbc").options(url=url, dbtable=table, **{"batchsize": "1000", **options}).mode("append").save()
