"""Benchmark decontamination with suffix arrays over the training text.

Each Arrow batch of documents is a shard.  Words are hashed and mapped to the benchmark's vocabulary; a word
position is kept only if it and its neighbour stand side by side somewhere in the benchmark too, which no
verbatim match of two or more words can miss.  The kept runs, with separators between them, get a suffix array (prefix
doubling), and every suffix of every benchmark item is binary-searched in it, word by word for all
suffixes at once.  The search gives the occurrences of each window and the longest verbatim match and its place.

The benchmark is read in blocks of at most BLOCK_BYTES of text; each block is one bounded broadcast and one pass
over the documents, so a benchmark of any size is searched whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._jobs import written

WINDOW = 13
MIN_SHARE_PERCENT = 5
BLOCK_BYTES = 16 << 20

_SCHEMA = "doc_id long, text_key long, n_words long, hit array<int>, items array<string>, longest_match int, longest_item string, longest_at int"


class Index:
    """The benchmark block: vocabulary, neighbour pairs, and the items' words one after another."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        words, bounds = [], [0]
        how = T.table("alnum", "lower")
        for _, off, raw in T.slices(pa.array(texts, pa.string())):
            w = T.Words(off, raw, how)
            words.append(w.hash)
            bounds.extend((bounds[-1] + np.cumsum(w.counts)).tolist())
        flat = np.concatenate(words) if words else np.zeros(0, T.U64)
        bounds = np.array(bounds)
        size = np.diff(bounds)
        self.vocabulary = np.unique(flat)
        self.words = np.searchsorted(self.vocabulary, flat).astype(np.int64) + 1
        self.item = np.repeat(np.arange(len(size)), size)  # of each word
        self.left = np.repeat(bounds[1:], size) - np.arange(len(flat))  # words from here to the item's end
        need = np.minimum(size, window)[self.item] if len(flat) else np.zeros(0, np.int64)
        self.least = need  # shortest match that counts, for each word's item
        self.need = np.where(self.left >= need, need, 0)  # window length of a window that starts here, else 0
        self.shortest = int(need.min()) if len(need) else 0
        same = self.item[1:] == self.item[:-1]
        self.pairs = np.unique((self.words[:-1] << 32 | self.words[1:])[same])
        self.ids = ids


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of an integer text, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        follow = np.full(n, -1, dtype=np.int64)
        follow[: n - step] = rank[step:] if step < n else []
        key = rank * (n + 1) + follow + 1
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, dtype=np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank, step = new, step * 2
        if step >= n or rank[order[-1]] == n - 1:
            return order


class Shard:
    """Kept runs of a batch: benchmark word numbers, with a distinct negative separator after each run."""

    def __init__(self) -> None:
        self.word: list[np.ndarray] = []
        self.row: list[np.ndarray] = []
        self.at: list[np.ndarray] = []

    def add(self, index: Index, first_row: int, words: T.Words) -> None:
        if not len(index.vocabulary) or not len(words):
            return
        number = np.minimum(np.searchsorted(index.vocabulary, words.hash), len(index.vocabulary) - 1)
        known = index.vocabulary[number] == words.hash
        number = number.astype(np.int64) + 1
        follows = np.zeros(len(words), dtype=bool)  # word i goes on with word i+1
        i = np.flatnonzero(known[:-1] & known[1:] & (words.row[:-1] == words.row[1:]))
        follows[i] = _member(number[i] << 32 | number[i + 1], index.pairs)
        begins = known.copy()
        begins[1:] &= ~follows[:-1]
        start, stop = np.flatnonzero(begins), np.flatnonzero(known & ~follows) + 1
        long = stop - start >= index.shortest
        start, stop = start[long], stop[long]
        if not len(start):
            return
        size = stop - start + 1
        at = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        ends = np.cumsum(size) - 1
        word = number[np.minimum(at, len(number) - 1)]
        word[ends] = 0
        self.word.append(word)
        self.row.append(words.row[np.minimum(at, len(number) - 1)] + first_row)
        self.at.append(at - words.bounds[words.row[np.minimum(at, len(number) - 1)]])

    def search(self, index: Index) -> Iterator[tuple[np.ndarray, ...]]:
        """(rows, word offsets, window lengths, items) of all window occurrences, then those of the longest matches."""
        if not self.word:
            return
        word, row, at = (np.concatenate(x) for x in (self.word, self.row, self.at))
        cut = np.flatnonzero(word == 0)
        word[cut] = -1 - np.arange(len(cut))  # no two separators are equal, so no match runs over one
        order = suffix_array(word)
        padded = np.concatenate((word, [np.iinfo(np.int64).min]))
        lo, hi = np.zeros(len(index.words), np.int64), np.full(len(index.words), len(order), np.int64)
        live, depth = np.arange(len(index.words)), 0
        while len(live):
            want = index.words[live + depth]
            a = self._edge(padded, order, lo[live], hi[live], depth, want, strict=False)
            b = self._edge(padded, order, a, hi[live], depth, want, strict=True)
            found = a < b
            live, a, b, depth = live[found], a[found], b[found], depth + 1
            lo[live], hi[live] = a, b
            full = live[index.need[live] == depth]
            if len(full):
                yield (*self._places(order, row, at, lo[full], hi[full]), depth, index.item[np.repeat(full, hi[full] - lo[full])], False)
            # where no longer match is found the last interval holds the longest ones; a deeper one replaces it below
            long = live[index.least[live] <= depth]
            if len(long):
                yield (*self._places(order, row, at, lo[long], hi[long]), depth, index.item[np.repeat(long, hi[long] - lo[long])], True)
            live = live[index.left[live] > depth]

    @staticmethod
    def _edge(text: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, want: np.ndarray, strict: bool) -> np.ndarray:
        """Binary search: the first place in [lo, hi) whose word at depth is >= want, or > want if strict."""
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) // 2
            got = text[np.minimum(order[np.minimum(mid, len(order) - 1)] + depth, len(text) - 1)]
            right = open_ & ((got <= want) if strict else (got < want))
            lo = np.where(right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)

    @staticmethod
    def _places(order: np.ndarray, row: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = hi - lo
        pos = order[np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
        return row[pos], at[pos]


def _searcher(broadcast):  # noqa: ANN001, ANN202
    how = T.table("alnum", "lower")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.lean()
        index: Index = broadcast.value
        for batch in batches:
            rows = batch.num_rows
            shard, count = Shard(), np.zeros(rows, dtype=np.int64)
            for i, off, raw in T.slices(batch.column("text")):
                w = T.Words(off, raw, how)
                count[i : i + len(off) - 1] = w.counts
                shard.add(index, i, w)
            base = np.concatenate(([0], np.cumsum(count)))
            hits, seen = [], []
            best, best_item, best_at = np.zeros(rows, np.int64), np.full(rows, -1), np.full(rows, -1)
            for row, at, depth, item, longest in shard.search(index):
                if longest:
                    order = np.lexsort((item, at))[::-1]  # the smallest place and item are written last
                    best[row[order]], best_item[row[order]], best_at[row[order]] = depth, item[order], at[order]
                else:
                    hits.append(np.stack((base[row] + at, base[row] + at + depth)))
                    seen.append(np.unique(row * len(index.ids) + item))
            covered = np.zeros(base[-1] + 1, dtype=np.int64)
            for a, b in hits:
                np.add.at(covered, a, 1)
                np.add.at(covered, b, -1)
            where = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
            per_row = np.searchsorted(where, base)
            local = where - np.repeat(base[:-1], np.diff(per_row)) if len(where) else where
            pair = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
            names = [index.ids[k] for k in (pair % max(1, len(index.ids)))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(count),
                    T.list_of(local.astype(np.int32), per_row, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(pair // max(1, len(index.ids)), np.arange(rows + 1)), pa.int32()), pa.array(names, pa.string())),
                    pa.array(best, pa.int32()),
                    pa.array([index.ids[k] if k >= 0 else None for k in best_item], pa.string()),
                    pa.array(best_at, pa.int32()),
                ],
                names=["doc_id", "text_key", "n_words", "hit", "items", "longest_match", "longest_item", "longest_at"],
            )
            T.trim()

    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = [sorted(set(x or ())) for x in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(c for n, c in zip(batch.schema.names, batch.columns) if n != "items"), pa.array([len(x) for x in items], pa.int64()), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items])],
            names=[n for n in batch.schema.names if n != "items"] + ["n_items", "items_sha256"],
        )


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = MIN_SHARE_PERCENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match, longest_item, longest_at) for every row.

    Words: A-Z lower-cased, runs of letters, digits and characters from U+0080.  A window is ``window`` successive words
    of an item, or all words of an item that has fewer.  n_hit counts the document's words inside any occurrence of
    a window; contaminated: n_hit > 0 and n_hit at least ``percent`` percent of n_words.  longest_match is the longest run of
    words (window length or more) that a suffix of an item shares with the document, longest_item and longest_at its
    item and word offset (0, null and -1 if there is none); of equally long ones the first in the document, then the smallest item_id
    as text, however many blocks the benchmark takes.

    Null or empty texts have no words and are never hit.  Items with null or no words match nothing; repeated items
    count once per item_id.  An empty benchmark leaves every document clean.  Rows that repeat a doc_id are
    judged one by one.  Other columns are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    parts = []
    for k in range(blocks):
        got = items.where(block == k).orderBy("item_id", "text").toPandas()
        index = spark.sparkContext.broadcast(Index(got["item_id"].tolist(), got["text"].tolist(), window))
        part = docs.mapInArrow(_searcher(index), _SCHEMA)
        parts.append(part if blocks == 1 else written(part))
    out = parts[0]
    if blocks > 1:
        every = reduce(DataFrame.unionByName, parts)
        out = (
            every.groupBy("doc_id", "text_key")
            .agg(
                F.max("n_words").alias("n_words"),
                F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"),
                F.flatten(F.collect_list("items")).alias("items"),
                F.min(F.struct((-F.col("longest_match")).alias("shortfall"), "longest_at", "longest_item")).alias("best"),
                (F.count("*") / blocks).cast("int").alias("copies"),
            )
            .withColumn("copies", F.explode(F.sequence(F.lit(1), "copies")))
            .withColumns({"longest_match": -F.col("best.shortfall"), "longest_at": F.col("best.longest_at"), "longest_item": F.col("best.longest_item")})
            .drop("copies", "best")
        )
    out = out.withColumn("n_hit", F.size("hit").cast("long")).drop("hit", "text_key").select("doc_id", "n_words", "longest_match", "longest_item", "longest_at", "n_hit", "items")
    out = out.mapInArrow(_digest, "doc_id long, n_words long, longest_match int, longest_item string, longest_at int, n_hit long, n_items long, items_sha256 string")
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", F.expr(f"n_hit > 0 and 100 * n_hit >= {percent} * n_words").alias("contaminated"), "longest_match", "longest_item", "longest_at"
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents whose doc_id has no contaminated row; all columns stay.  Rows with a null doc_id stay only if no such row is contaminated."""
    bad = written(contamination(documents, benchmark).where("contaminated").select("doc_id").distinct())
    clean = documents.join(bad, documents["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti")
    return clean
