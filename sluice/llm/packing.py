"""Packing into sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows and a rest, the rest into pieces of at most PIECE ids.  Full windows are sequences
as they stand.  The other pieces are dealt at random into groups of about GROUP pieces, and each group is
parted into windows: every piece starts as a partial partition (its size in one window, nothing in the others); the two partitions
with the largest spread are merged, the fullest windows of one with the emptiest of the other, until one is left.
The windows of that are near-equal.  A group starts with as many windows as its ids need; while the fullest window exceeds the
capacity, the number rises and the differencing runs again.

Groups are equal in kind (dealt by a hash of the row, not of a key), so there is no hot one; a worker holds one group's sizes.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._jobs import written
from .tokens import encoder

CAPACITY = 2048
PIECE = 512
GROUP = 2048
END_ID = 1

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    full = n // capacity * capacity
    return [(a, capacity) for a in range(0, full, capacity)] + [(a, min(piece, n - a)) for a in range(full, n, piece)]


def _pieces(path: str, end_id: int, capacity: int, piece: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, end_id)
        for batch in batches:
            text = batch.column("text")
            for i, off, _ in T.slices(text):
                part, out = text.slice(i, len(off) - 1), []
                ids, bounds = encode([t or "" for t in part.to_pylist()])
                raw, bounds = memoryview(ids.astype("<u4", copy=False)).cast("B"), bounds.tolist()
                for k, (x, y) in enumerate(zip(bounds, bounds[1:])):
                    out += [(k, a, m, zlib.crc32(raw[4 * (x + a) : 4 * (x + a + m)]), y - x) for a, m in _cut(y - x, capacity, piece)]
                cols = np.array(out, dtype=np.int64).reshape(-1, 5)
                ids = batch.column("doc_id").slice(i, len(off) - 1).take(pa.array(cols[:, 0]))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(cols[:, j]) for j in range(1, 5))], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            T.trim()

    return run


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each size: Karmarkar-Karp differencing into the given number of windows."""
    n = len(sizes)
    if windows == 1 or n <= 1:
        return np.zeros(n, dtype=np.int64)
    after = np.full(n, -1)  # the pieces of a window as a linked list
    heap = []
    for k in np.argsort(-sizes, kind="stable").tolist():
        load = np.zeros(windows, dtype=np.int64)
        head = np.full(windows, -1)
        load[0], head[0] = sizes[k], k
        heap.append((-int(sizes[k]), k, load, head, head.copy()))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, k, load_a, head_a, tail_a = heapq.heappop(heap)
        _, _, load_b, head_b, tail_b = heapq.heappop(heap)
        head_b, tail_b = head_b[::-1], tail_b[::-1]
        load = load_a + load_b[::-1]
        both = (head_a >= 0) & (head_b >= 0)
        after[tail_a[both]] = head_b[both]
        head, tail = np.where(head_a >= 0, head_a, head_b), np.where(head_b >= 0, tail_b, tail_a)
        order = np.argsort(-load, kind="stable")
        load, head, tail = load[order], head[order], tail[order]
        load -= load[-1]
        heapq.heappush(heap, (-int(load[0]), k, load, head, tail))
    out = np.empty(n, dtype=np.int64)
    for w, at in enumerate(heap[0][3].tolist()):
        while at >= 0:
            out[at], at = w, after[at]
    return out


def windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size, none over capacity; sizes are at most capacity."""
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        of = differencing(sizes, count)
        most = int(np.bincount(of, weights=sizes).max()) if len(sizes) else 0
        if most <= capacity:
            return of
        count = max(count + 1, int(count * most / capacity * 0.998))


def _packed(capacity: int):  # noqa: ANN202
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "row"], kind="stable").reset_index(drop=True)
        size = pdf["length"].to_numpy()
        whole = size == capacity
        window = np.empty(len(size), dtype=np.int64)
        rest = windows(size[~whole], capacity) if (~whole).any() else np.zeros(0, np.int64)
        window[~whole] = rest
        first = int(rest.max()) + 1 if len(rest) else 0
        window[whole] = first + np.arange(whole.sum())
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(size[order])
        begins = np.concatenate(([0], np.flatnonzero(np.diff(window[order])) + 1)) if len(size) else np.zeros(0, np.int64)
        base = np.repeat((ends - size[order])[begins], np.diff(np.append(begins, len(size))))
        offset = np.empty(len(size), dtype=np.int64)
        offset[order] = ends - size[order] - base
        return pdf.drop(columns=["row", "group"]).assign(sequence_id=(int(key[0]) << 32) + window, offset=offset)

    return run


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, piece: int = PIECE, group: int = GROUP, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for every piece.

    A null or empty text is its end id alone, so every row of documents has at least one piece.  Rows that repeat a
    doc_id (or have none) are documents of their own.  An empty table gives an empty result.  Other columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = written(docs.mapInArrow(_pieces(tokenizer_path, end_id, capacity, piece), _PIECES).withColumn("row", F.monotonically_increasing_id()))
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(_packed(capacity), _PIECES + ", sequence_id long, offset long")
