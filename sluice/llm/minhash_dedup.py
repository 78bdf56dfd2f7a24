"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash signatures.

A document is the set of its distinct 5-word shingles.  Its signature is SYMBOLS = 68 MinHash values of 16
bits.  Two sets with Jaccard similarity J differ in about (1 - J) * 68 symbols, 17 at J = 0.75.  The join
finds every pair of signatures that differ in at most REACH = 33 symbols: the signature is cut into 17
chunks of 4 symbols; by the pigeonhole principle a pair within 33 differences has a chunk with at most one
(17 chunks with two each would need 34), so each chunk is indexed under the four keys that leave out one of its
symbols and two such chunks meet in one of these.  A pair at J = 0.75 exceeds the reach with probability
below 1e-5, one at 0.8 below 1e-8.  Every link is confirmed on the full sets.

Groups of a key can be large (copies, shared passages), so pairs are not emitted group by group:

1. Documents with equal sets are one node (the smallest doc_id), so exact copies never meet in a key.
2. Every member of a key group meets the group's smallest member only; the closest of these by signature is
   confirmed on the full sets.  This joins nearly all of a large near-copy group in a linear number of pairs.
3. Only groups that still hold several components go on.  Their rows carry the signatures, and members of
   different components are compared in blocks of at most BLOCK rows inside the workers; what leaves them is a
   spanning forest of the pairs within reach and of compatible sizes.  Its components are clusters.
4. Within each cluster the full sets of different components are compared, in pairs of blocks of at most FULL_BLOCK
   nodes.  Steps 3 and 4 are exact: no link within the reach between two different components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import _text as T
from ._jobs import components, parted, written

WORDS = 5
SIMILAR_PERCENT = 75
CHUNKS, WIDTH = 17, 4
SYMBOLS = CHUNKS * WIDTH
REACH = 2 * CHUNKS - 1
BLOCK = 4096
FULL_BLOCK = 256
COLUMNS = 1 << 14

_XOR = T.seeds(SYMBOLS, 41)
_MUL = T.seeds(SYMBOLS, 42) | T.U64(1)


def _sets(arr: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row, shingle) for slices; shingles are distinct and sorted within a row."""
    how = T.table("space", "lower")
    for i, off, raw in T.slices(arr):
        row, _, h = T.grams(T.Words(off, raw, how), WORDS, whole_if_shorter=True)
        row, h = T.distinct(row, h)
        yield i, len(off) - 1, row, h


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    T.lean()
    for batch in batches:
        for i, rows, row, h in _sets(batch.column("text")):
            size = np.bincount(row, minlength=rows)
            has = np.flatnonzero(size)
            starts = np.concatenate(([0], np.cumsum(size)))[has]
            fp = np.zeros((2, rows), dtype=T.U64)
            sig = np.zeros((rows, SYMBOLS), dtype=np.uint16)
            if len(h):
                fp[0, has] = np.add.reduceat(T.mix(h ^ _XOR[0]), starts)
                fp[1, has] = np.bitwise_xor.reduceat(T.mix(h ^ _XOR[1]), starts)
                for j in range(SYMBOLS):
                    sig[has, j] = np.minimum.reduceat((h ^ _XOR[j]) * _MUL[j], starts).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, rows), pa.array(size, pa.int64()), *(pa.array(x.view(np.int64)) for x in fp), T.binary_of(sig.reshape(-1), np.arange(rows + 1) * SYMBOLS)],
                names=["doc_id", "n_shingles", "fp1", "fp2", "sig"],
            )
        T.trim()


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    T.lean()
    for batch in batches:
        for i, rows, row, h in _sets(batch.column("text")):
            bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, rows), T.list_of(h.view(np.int64), bounds, pa.int64())], names=["doc_id", "shingles"])


def _matrix(col: pa.Array) -> np.ndarray:
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]].view(np.uint16).reshape(len(col), SYMBOLS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """68 keys a document: the chunk, the symbol left out, and the other three symbols, packed into 55 bits."""
    for batch in batches:
        for k in range(0, batch.num_rows, 4096):
            part = batch.slice(k, 4096)
            sig = _matrix(part.column("sig")).astype(np.int64).reshape(-1, CHUNKS, WIDTH)
            keys = np.empty((part.num_rows, CHUNKS, WIDTH), dtype=np.int64)
            for out in range(WIDTH):
                keys[:, :, out] = reduce(lambda a, b: a << 16 | b, (sig[:, :, j] for j in range(WIDTH) if j != out), np.arange(CHUNKS) * WIDTH + out)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), *(pa.array(np.repeat(part.column(c).to_numpy(), SYMBOLS)) for c in ("node", "n_shingles"))], names=["key", "node", "n"])


def _distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d = (_matrix(batch.column("sig_a")) != _matrix(batch.column("sig_b"))).sum(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(d, pa.int32())], names=["a", "b", "distance"])


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n items the smallest one that it reaches over the edges (i, j)."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root != root[root]).any():
            root = root[root]
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
    return root


def _edges(node: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """A spanning forest of the edges, so that at most one row a node leaves the worker."""
    root = _forest(i, j, len(node))
    at = np.flatnonzero(root != np.arange(len(node)))
    out = np.unique(np.stack((node[root[at]], node[at])), axis=1) if len(at) else np.zeros((2, 0), dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=["a", "b"])


def _by_group(column: str, work: Callable[[pa.Table], pa.RecordBatch], one: bool) -> Callable:
    """Runs work on whole groups of rows that come sorted by column: on one group each, or on all that a batch ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, t]) if rest is not None else t
            group = rest.column(column).combine_chunks().to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero(group[1:] != group[:-1]) + 1).tolist()
            cuts = cuts if one else cuts[-1:]
            for x, y in zip([0, *cuts], cuts):
                yield work(rest.slice(x, y - x))
            rest = rest.slice(cuts[-1]) if cuts else rest
        if rest is not None and rest.num_rows:
            yield work(rest)

    return run


def _columns(t: pa.Table, *names: str) -> tuple[np.ndarray, ...]:
    return tuple(t.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in names)


def _reachable(t: pa.Table) -> pa.RecordBatch:
    """A forest over the pairs of different components within reach; groups have at most 2 * BLOCK rows."""
    group, node, label, n, side = _columns(t, "group", "node", "label", "n", "side")
    sig = np.concatenate([_matrix(x) for x in t.column("sig").chunks])
    ends = np.searchsorted(group, group, "right")
    at, lag, found = np.arange(len(group)), 1, [np.zeros((2, 0), dtype=np.int64)]
    while len(at := at[at + lag < ends[at]]):
        b = at + lag
        small, large = np.minimum(n[at], n[b]), np.maximum(n[at], n[b])
        ok = (label[at] != label[b]) & (100 * small >= SIMILAR_PERCENT * large) & ((side[at] < 0) | (side[at] != side[b]))
        i, j = at[ok], b[ok]
        for k in range(0, len(i), 1 << 16):
            x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            near = (sig[x] != sig[y]).sum(axis=1) <= REACH
            found.append(np.stack((x[near], y[near])))
        lag += 1
    return _edges(node, *np.concatenate(found, axis=1))


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers blocks of at most FULL_BLOCK successive nodes of a cluster; rows come sorted by cluster and label."""
    from pyspark import TaskContext

    block, size, last = (TaskContext.get().partitionId() << 40) - 1, 0, None
    for batch in batches:
        out = np.empty(batch.num_rows, dtype=np.int64)
        for k, c in enumerate(batch.column("cluster").to_numpy()):
            if c != last or size == FULL_BLOCK:
                block, size, last = block + 1, 0, c
            out[k], size = block, size + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "block"])


def _linked(t: pa.Table) -> pa.RecordBatch:
    """A forest over the links between different components in one pair of blocks, by the sizes of set intersections."""
    node, label = _columns(t, "node", "label")
    sets = t.column("shingles").combine_chunks()
    sets = sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets
    size = np.diff(sets.offsets.to_numpy())
    row = np.repeat(np.arange(len(node)), size)
    column = np.unique(sets.flatten().to_numpy(), return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.bincount(column, minlength=1)[column] > 1
    row, column = row[shared], np.cumsum(np.diff(column[shared], prepend=-1) != 0) - 1
    both = np.zeros((len(node), len(node)), dtype=np.float32)
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + COLUMNS + 1, COLUMNS))
    for k, (x, y) in enumerate(zip(edges, edges[1:])):
        part = np.zeros((len(node), COLUMNS), dtype=np.float32)
        part[row[x:y], column[x:y] - k * COLUMNS] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    similar = 100 * both >= SIMILAR_PERCENT * (size[:, None] + size[None, :] - both)
    i, j = np.nonzero(np.triu(similar & (label[:, None] != label[None, :]), 1))
    return _edges(node, i, j)


def _confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity.  pairs is a written table."""
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    full = written(docs.join(ids, "doc_id", "left_semi").mapInArrow(_shingles, "doc_id long, shingles array<long>"))
    side = lambda x: full.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"s_{x}"))
    both = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    return written(
        pairs.join(side("a"), "a").join(side("b"), "b").withColumn("both", both).where(F.lit(100) * F.col("both") >= F.lit(SIMILAR_PERCENT) * (F.size("s_a") + F.size("s_b") - F.col("both"))).select("a", "b").distinct()
    )


def _links(docs: DataFrame, clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """All links between different components within each cluster (node, component), up to connectivity.

    The nodes of a cluster are put in order of their component and cut into blocks; each pair of blocks, other than
    those of one component only, is one unit of work with the full sets of its nodes.
    """
    named = clusters.select("node", F.col("component").alias("cluster")).join(labels.select("node", F.col("component").alias("label")), "node", "left")
    named = named.select("cluster", F.coalesce("label", "node").alias("label"), "node")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = named.repartitionByRange(parts, "cluster", "label", "node").sortWithinPartitions("cluster", "label", "node")
    nodes = written(ordered.mapInArrow(_blocked, "cluster long, label long, node long, block long"))
    blocks = nodes.groupBy("cluster", "block").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    x, y = blocks.alias("x"), blocks.alias("y")
    work = x.join(y, (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.block") <= F.col("y.block")) & (F.least("x.low", "y.low") < F.greatest("x.high", "y.high")))
    work = work.select(F.xxhash64("x.block", "y.block").alias("unit"), F.col("x.block").alias("first"), F.col("y.block").alias("second"))
    work = work.select("unit", F.explode(F.array_distinct(F.array("first", "second"))).alias("block"))
    busy = written(work)
    used = nodes.join(busy.select("block").distinct(), "block", "left_semi")
    full = written(docs.join(written(used.select(F.col("node").alias("doc_id"))), "doc_id", "left_semi").mapInArrow(_shingles, "doc_id long, shingles array<long>"))
    units = used.join(busy, "block").join(full, F.col("node") == F.col("doc_id")).select("unit", "node", "label", "shingles")
    return written(units.repartition("unit").sortWithinPartitions("unit", "node").mapInArrow(_by_group("unit", _linked, one=True), "a long, b long").distinct())


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of documents (doc_id, text, ...).

    Words are runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.  A text with fewer than five words
    is one shingle; a null, empty or blank text has none (n_shingles 0) and is linked with nothing.
    component_id is the smallest doc_id reachable over links.  Rows that repeat a doc_id are one node: all
    carry its component, and each is marked kept if the doc_id is.  Rows with a null doc_id are linked with nothing
    and get a null component_id and kept = true.  An empty table gives an empty result; other columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = written(docs.mapInArrow(_features, "doc_id long, n_shingles long, fp1 long, fp2 long, sig binary"))
    some = features.where("n_shingles > 0 and doc_id is not null")
    classes = written(some.groupBy("fp1", "fp2", "n_shingles").agg(F.min("doc_id").alias("node"), F.min("sig").alias("sig")))
    same = some.join(classes.select("fp1", "fp2", "n_shingles", "node"), ["fp1", "fp2", "n_shingles"]).select("doc_id", "node")
    nodes = classes.select("node", "n_shingles", "sig")
    # counts and leads of the keys by partial aggregation, then a join that Spark can split: no key's group meets in one task
    keys = nodes.mapInArrow(_keys, "key long, node long, n long")
    heads = written(keys.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("lead")).where("members > 1").select("key", "lead"))
    groups = written(keys.join(heads, "key"))
    led = groups.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    sig = lambda x: nodes.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    fits = F.lit(100) * F.least("n_a", "n_b") >= F.lit(SIMILAR_PERCENT) * F.greatest("n_a", "n_b")
    near = led.join(sig("a"), "a").join(sig("b"), "b").where(fits).select("a", "b", "sig_a", "sig_b").mapInArrow(_distance, "a long, b long, distance int").where(F.col("distance") <= REACH)
    first = _confirmed(docs, written(near.groupBy("b").agg(F.min_by("a", F.struct("distance", "a")).alias("a")).select("a", "b")))
    labels = components(first)

    labelled = written(groups.join(labels, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("label")))
    mixed = labelled.groupBy("key").agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    open_groups = labelled.join(written(mixed.select("key", "members")), "key")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = (
        open_groups.withColumns({"blocks": blocks, "mine": mine})
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))).alias("group"),
            "node", "label", "n", F.when(F.col("mine") == F.col("other"), -1).otherwise(F.col("mine")).alias("side"),
        )
        .join(nodes.select("node", "sig"), "node")
    )
    near = dealt.repartition("group").sortWithinPartitions("group", "node").mapInArrow(_by_group("group", _reachable, one=False), "a long, b long").distinct()
    second = _links(docs, components(near), labels)
    # copies are folded in through their nodes; a doc_id whose rows have different texts ties their nodes together
    ties = same.where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    whole = written(components(first.union(second).union(ties)))
    return (
        features.select("doc_id", "n_shingles")
        .join(whole.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), (F.col("doc_id").isNull() | (F.coalesce("component", "doc_id") == F.col("doc_id"))).alias("kept"))
    )


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """The rows of documents that stay: one row of each group, with all columns.

    Of rows that repeat a kept doc_id one stays (the one with the smallest text, nulls last, then any).  Only rows that
    may go move, the others are told by a sieve.
    """
    judged = near_duplicates(documents).where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("copies"), F.max("kept").alias("kept"))
    open_ = written(judged.where("not kept or copies > 1").select(F.col("doc_id").alias("of"), "kept"))
    # the columns of documents are one struct meanwhile, so that none clashes
    own = documents.select(F.col("doc_id").cast("long").alias("at"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    some, others = parted(own, "at", open_, "of")
    found = some.join(open_, some["at"] == open_["of"], "left")
    nth = F.row_number().over(Window.partitionBy("at").orderBy(F.col("row")["text"].asc_nulls_last()))
    again = found.where("kept").withColumn("nth", nth).where("nth = 1")
    stay = others.select("row").unionByName(found.where("of is null").select("row")).unionByName(again.select("row"))
    return stay.select(*[F.col("row")[c].alias(c) for c in documents.columns])
