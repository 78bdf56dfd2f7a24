"""Order-independent checksums: bytes, rows and an exclusive-or of row hashes, which merge in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.crc64 import crc64


def canonical(column: Column, kind: str) -> Column:
    """A value as text, the same on every engine; NULL as \\N."""
    text = F.hex(column) if kind == "binary" else F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS") if kind.startswith("timestamp") else column.cast("string")
    return F.coalesce(text, F.lit("\\N"))


def row_text(df: DataFrame, columns: list[str] | None = None) -> Column:
    kinds = dict(df.dtypes)
    return F.concat_ws("\x01", *[canonical(F.col(f"`{c}`"), kinds[c]) for c in columns or df.columns])


def portable_hash(text: Column) -> Column:
    """60 bits of MD5 as a bigint: built in here and easy to write in any SQL."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def checksum(df: DataFrame, columns: list[str] | None = None, *, by: list[str] | None = None, hash_with: str = "md5") -> DataFrame:
    """(by..., total_bytes, total_rows, checksum).  hash_with: md5 (JVM only) or crc64 (an Arrow UDF)."""
    text = row_text(df, columns)
    value = portable_hash(text) if hash_with == "md5" else crc64(text.cast("binary"))
    rows = df.select(*(by or []), F.octet_length(text).cast("bigint").alias("_n"), value.alias("_h"))
    return rows.groupBy(*(by or [])).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_bytes"), F.count("*").alias("total_rows"), F.coalesce(F.bit_xor("_h"), F.lit(0)).cast("bigint").alias("checksum"))


def merge(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Partial checksums as one."""
    return parts.groupBy(*(by or [])).agg(F.coalesce(F.sum("total_bytes"), F.lit(0)).cast("bigint").alias("total_bytes"), F.coalesce(F.sum("total_rows"), F.lit(0)).cast("bigint").alias("total_rows"), F.coalesce(F.bit_xor("checksum"), F.lit(0)).cast("bigint").alias("checksum"))


def compare(remote: DataFrame, local: DataFrame) -> None:
    """Raises where the two one-row checksums differ."""
    a, b = remote.first(), local.first()
    if a != b:
        pair = lambda k: f"({k}: {a[k]} vs {b[k]})"
        raise ValueError("checksum mismatched remote vs local => " + " ".join(map(pair, ("checksum", "total_rows", "total_bytes"))))


def statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_rows, n_null, n_distinct, min_value, max_value), values as text; one pass and one row a column."""
    stats = []
    for c in columns:
        x = F.col(f"`{c}`")
        stats += [F.count("*").alias(f"{c}|r"), F.count_if(x.isNull()).alias(f"{c}|u"), F.count_distinct(x).alias(f"{c}|d"), F.min(x).cast("string").alias(f"{c}|l"), F.max(x).cast("string").alias(f"{c}|h")]
    one = df.agg(*stats)
    col = lambda c, k: F.col(f"`{c}|{k}`")
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), col(c, "r").alias("n_rows"), col(c, "u").alias("n_null"), col(c, "d").alias("n_distinct"), col(c, "l").alias("min_value"), col(c, "h").alias("max_value")) for c in columns])
    return one.select(F.inline(rows))
