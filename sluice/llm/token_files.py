"""Token files: Parquet tables of token ids, written for selective reads.

The ids are a list column with dictionary pages (ids of a vocabulary of 2**16 or fewer take at most two bytes), the
counters are delta-encoded, row groups and pages have set sizes, and the writer keeps page indexes, so that a reader can take a range
of documents or the metadata columns alone.  Spark's own writer is used, so the files go to any Hadoop
file system and are committed task by task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import _text as T
from .tokens import encoder

END_ID = 1
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000

_SCHEMA = "part int, doc_id long, part_start long, n_tokens long, tokens array<int>"


def writer_options(row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> dict[str, str]:
    return {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.enable.dictionary": "false",  # delta encoding for the counters
        "parquet.enable.dictionary#tokens.list.element": "true",
        "parquet.dictionary.page.size": str(1 << 20),
        "parquet.columnindex.truncate.length": "16",
    }


def _encoded(path: str, end_id: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, start = encoder(path, end_id), TaskContext.get().partitionId(), 0
        for batch in batches:
            text = batch.column("text")
            for i, off, _ in T.slices(text):
                rows = len(off) - 1
                ids, bounds = encode([t or "" for t in text.slice(i, rows).to_pylist()])
                size = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, part, np.int32)), batch.column("doc_id").slice(i, rows), pa.array(start + bounds[:-1]), pa.array(size), T.list_of(ids.astype(np.int32), bounds, pa.int32())],
                    names=["part", "doc_id", "part_start", "n_tokens", "tokens"],
                )
                start += int(bounds[-1])

    return run


def write_tokens(documents: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, **sizes: int) -> None:
    """Writes documents (doc_id, text, ...) as token files below path, in ascending order of doc_id over all files.

    A null or empty text is the end id alone.  Rows that repeat a doc_id stay, in the order of a hash of their text;
    null doc_ids come first.  An empty table gives an empty table.  Other columns are not written.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns({"h": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    by = ("doc_id", "h", "nth")  # the last two split the rows of a doc_id that repeats very often
    ordered = docs.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("doc_id", "text")
    ordered.mapInArrow(_encoded(tokenizer_path, end_id), _SCHEMA).write.options(**writer_options(**sizes)).parquet(path)


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """(doc_id, start, n_tokens, tokens): start is the number of ids of all documents before.  columns: fewer of these, of which only what is named is read."""
    files = spark.read.schema(_SCHEMA).parquet(path)
    columns = columns or ("doc_id", "start", "n_tokens", "tokens")
    if "start" not in columns:
        return files.select(*columns)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row a file: small enough to broadcast at any size
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return files.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("part_start")).select(*columns)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column("tokens")
        off = tokens.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False)).astype("<u4", copy=False)).cast("B")
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(off, off[1:])]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of read_tokens' rows; the crc32 is unsigned, over little-endian unsigned 32-bit ids."""
    return tokens.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
