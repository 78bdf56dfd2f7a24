"""Dump files as DataFrames, through Spark's own readers, so that any Hadoop file system serves."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import ROW_ID
from .parse import CsvParser, Dialect, SqlParser

PARSED = f"path string, {ROW_ID} long, columns array<string>, fields array<binary>"
_BATCH = 5000


def _emit(path: str, rows: Iterator[tuple[int, list[str] | None, list]], base: int) -> Iterator[pa.RecordBatch]:
    kept: tuple[list, list, list] = ([], [], [])

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([path] * len(kept[0]), pa.string()), pa.array(kept[0], pa.int64()), pa.array(kept[1], pa.list_(pa.string())), pa.array(kept[2], pa.list_(pa.binary()))], names=["path", ROW_ID, "columns", "fields"])
        for x in kept:
            x.clear()
        return out

    for k, (_, columns, fields) in enumerate(rows, 1):
        for x, v in zip(kept, (base + k, columns, fields)):
            x.append(v)
        if len(kept[0]) == _BATCH:
            yield batch()
    if kept[0]:
        yield batch()


def _local(path: str) -> str:
    return path.removeprefix("file:").replace("///", "/") if path.startswith("file:") else path


def _parser(kind: str, dialect: Dialect, backslash: bool, bases: dict[str, int]):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                data, base = data.as_py(), bases.get(_local(path), 0)
                if kind == "sql":
                    yield from _emit(path, SqlParser(backslash).rows(data), base)
                    continue
                csv, start, names = CsvParser(dialect), 0, None
                if dialect.header:
                    start, names = csv.header(data)
                yield from _emit(path, ((at, names, row) for at, row in csv.records(data, start)), base)

    return run


def read_whole(spark: SparkSession, paths: list[str], kind: str, bases: dict[str, int] | None = None, dialect: Dialect | None = None, backslash: bool = True) -> DataFrame:
    """(path, row id, columns, fields) of CSV or SQL files, each file one task: for records that may hold line ends.

    bases: the row id before each file's first row.  columns: the header's or INSERT's names in lower case, null if there are none.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    bases = {_local(k): v for k, v in (bases or {}).items()}
    return files.repartition(max(1, len(paths)), "path").mapInArrow(_parser(kind, dialect or Dialect(), backslash, bases), PARSED)


def _lines(dialect: Dialect, headers: dict[str, list[str]] | None, bases: dict[str, int]):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv, seen = CsvParser(dialect), {}
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for path, block, line in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "value"))):
                at = seen.get((path, block), block + 1)
                raw = line.encode("utf-8", "surrogateescape")
                seen[path, block] = at + len(raw) + 1
                if block == 0 and at == 1 and headers is not None:
                    continue
                header = None if headers is None else headers[path]
                for _, row in csv.records(raw):
                    for x, v in zip(out, (path, bases.get(_local(path), 0) + at, header, row)):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.string())), pa.array(out[3], pa.list_(pa.binary()))], names=["path", ROW_ID, "columns", "fields"])

    return run


def read_lines(spark: SparkSession, paths: list[str], bases: dict[str, int] | None = None, dialect: Dialect | None = None) -> DataFrame:
    """The same for CSV files in strict format (no line end inside a field), which Spark splits wherever it likes.

    Row ids are byte places: unique and rising within a file, with gaps.  Each file has a header of its own.
    """
    dialect = dialect or Dialect()
    headers = None
    if dialect.header:  # by the path as the rows will name it; an empty file has none
        firsts = (spark.read.text(p).select("value", F.col("_metadata.file_path").alias("path")).first() for p in paths)
        headers = {x.path: CsvParser(dialect).header(x.value.encode())[1] for x in firsts if x}
    text = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    bases = {_local(k): v for k, v in (bases or {}).items()}
    return text.mapInArrow(_lines(dialect, headers, bases), PARSED)


def read_parquet(spark: SparkSession, paths: list[str], bases: dict[str, int] | None = None) -> DataFrame:
    """Parquet files with lower-cased names and exact row ids: the file's base and the row's place in it."""
    df = spark.read.parquet(*paths)
    df = df.select(F.col("_metadata.file_path").alias("path"), (F.col("_metadata.row_index") + 1).alias(ROW_ID), *[F.col(f"`{c}`").alias(c.lower()) for c in df.columns])
    for path, base in (bases or {}).items():
        if base:
            df = df.withColumn(ROW_ID, F.when(F.col("path").endswith(_local(path)), F.col(ROW_ID) + base).otherwise(F.col(ROW_ID)))
    return df


def named(parsed: DataFrame, names: list[str], binary: set[str] = frozenset()) -> DataFrame:
    """Parsed rows with their fields as columns; text unless named in binary."""
    wide = parsed.select(ROW_ID, *[F.get("fields", F.lit(k)).alias(n) for k, n in enumerate(names)])
    return wide.select(ROW_ID, *[F.col(f"`{n}`") if n in binary else F.col(f"`{n}`").cast("string").alias(n) for n in names])
