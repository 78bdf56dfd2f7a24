"""Toxicity by weak supervision.

Voters are lexicon entries (words and word beginnings of 3 to 6 bytes that the labelled sample ties to either label, and a short fixed
list) and text patterns.  A generative model with one hidden label estimates, by expectation-maximisation, each voter's rates of
firing under both labels; the given label of a sampled document is one more voter with a fixed accuracy.  Correlations of voters given
the hidden label are estimated from their residuals, and a voter counts the less, the more it repeats others.  The
posterior labels train a linear classifier on hashed word and word-beginning features, which scores every text.

Only the sample (``sample`` labelled documents with the smallest hash of doc_id, outside the held-out fold) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _linear
from . import _text as T

BUCKETS = 1 << 20
SAMPLE = 6000
VOTERS = 400
GOLD_ACCURACY = 0.97
LIMIT = 0.3
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 0.1, 1e-2, 1e-5, 10
_SHORT = (3, 4, 5, 6)

# A short list of insults as seed voters.
SEED_WORDS = ["clown", "disgusting", "fool", "garbage", "hate", "idiot", "jerk", "loser", "moron", "pathetic", "scum", "stupid", "trash", "ugly", "worthless"]
PATTERNS = ["many_capitals", "exclamations", "masked_word"]


def _buckets(w: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word and of every beginning of a longer word."""
    rows, out = [w.row], [w.hash]
    for k in _SHORT:
        long = w.end - w.start > k
        rows.append(w.row[long])
        out.append(T.mix(T.range_hash(w.prefix, w.ipow, w.start[long], w.start[long] + k) ^ T.U64(k)))
    return np.concatenate(rows), (np.concatenate(out) >> T.U64(24)).astype(np.int64) % BUCKETS


def _patterns(off: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """rows x PATTERNS: whether over 30 % of ASCII letters are capitals, there are three exclamation marks, or a word masked by * or @."""
    total = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[off])
    capital = (raw >= 65) & (raw <= 90)
    letter = capital | ((raw >= 97) & (raw <= 122))
    masked = np.zeros(len(raw), dtype=bool)
    if len(raw) > 2:
        masked[1:-1] = ((raw[1:-1] == 42) | (raw[1:-1] == 64)) & letter[:-2] & letter[2:]
    return np.stack((10 * total(capital) > 3 * np.maximum(total(letter), 20), total(raw == 33) >= 3, total(masked) > 0), axis=1)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    T.lean()
    how = T.table("alnum", "lower")
    for batch in batches:
        for i, off, raw in T.slices(batch.column("text")):
            rows = len(off) - 1
            row, bucket = T.distinct(*_buckets(T.Words(off, raw, how)))
            bounds = np.searchsorted(row, np.arange(rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, rows), batch.column("toxic").slice(i, rows), T.binary_of(bucket.astype(np.int32), bounds), T.binary_of(_patterns(off, raw).astype(np.uint8).reshape(-1), np.arange(rows + 1) * len(PATTERNS))],
                names=["doc_id", "toxic", "bucket", "pattern"],
            )


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 15) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Posterior probability of label 1 for each row, and the model.

    votes: rows x voters, 1 where a voter fires.  gold: given labels, a voter of accuracy GOLD_ACCURACY.
    """
    n, m = votes.shape
    v = votes.astype(np.float32)
    post = np.where(gold == 1, GOLD_ACCURACY, 1 - GOLD_ACCURACY)
    weight = np.ones(m)
    rate1 = rate0 = np.zeros(m)
    for _ in range(rounds):
        one, zero = post.sum(), (1 - post).sum()
        rate1 = (post @ v + 0.5) / (one + 1)
        rate0 = ((1 - post) @ v + 0.5) / (zero + 1)
        rest = np.outer((-post).astype(np.float32), (rate1 - rate0).astype(np.float32))
        rest += v
        rest -= rate0.astype(np.float32)
        rho = rest.T @ rest / max(1, n)
        scale = np.sqrt(np.diag(rho)) + 1e-9
        rho = np.abs(rho / np.outer(scale, scale))
        np.fill_diagonal(rho, 0)
        weight = 1 / (1 + np.where(rho > 0.1, rho, 0).sum(axis=0))
        fire, quiet = np.log(rate1 / rate0), np.log((1 - rate1) / (1 - rate0))
        logit = np.log((one + 1) / (zero + 1)) + v @ (weight * (fire - quiet)) + (weight * quiet).sum()
        logit += np.where(gold == 1, 1, -1) * np.log(GOLD_ACCURACY / (1 - GOLD_ACCURACY))
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post, {"rate1": rate1, "rate0": rate0, "weight": weight}


def _fit(sample: pa.Table) -> tuple[np.ndarray, float]:
    """Weight of each bucket (BUCKETS of them) and bias."""
    gold = np.array(sample.column("toxic").to_pylist(), dtype=np.int64)
    n = len(gold)
    weights = np.zeros(BUCKETS, dtype=np.float32)
    if not n or gold.min() == gold.max():
        share = (gold.sum() + 0.05) / (n + 1) if n else 0.05
        return weights, float(np.log(share / (1 - share)))
    column = sample.column("bucket").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
    bucket = np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]].view(np.int32)
    df = np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero(df >= 3)  # rarer ones are left out of the model
    number = np.full(BUCKETS, -1, dtype=np.int32)
    number[used] = np.arange(len(used))
    index = number[bucket]
    keep = index >= 0
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(off) // 4)[keep]
    index = index[keep]
    del bucket, keep
    bounds = np.searchsorted(row, np.arange(n + 1))
    # lexicon voters: the strongest ties to a label, by a z score of the difference of rates
    ones = np.bincount(index, weights=gold[row], minlength=len(used))
    zeros = np.bincount(index, minlength=len(used)) - ones
    p1, p0 = (ones + 0.5) / (gold.sum() + 1), (zeros + 0.5) / (n - gold.sum() + 1)
    z = (p1 - p0) / np.sqrt(p1 / gold.sum() + p0 / (n - gold.sum()))
    toxic = np.argsort(-z, kind="stable")[:VOTERS]
    toxic = toxic[(z[toxic] > 3) & (ones[toxic] > 2 * zeros[toxic] * gold.sum() / (n - gold.sum()))]
    seeds = T.Words(*T.buffers(pa.array(SEED_WORDS)), T.table("alnum", "lower"))
    seeds = number[(seeds.hash >> T.U64(24)).astype(np.int64) % BUCKETS]
    lexicon = np.unique(np.concatenate((toxic, seeds[seeds >= 0])))
    voter = np.full(len(used), -1)
    voter[lexicon] = np.arange(len(lexicon))
    votes = np.zeros((n, len(lexicon) + len(PATTERNS)), dtype=np.uint8)
    fired = voter[index] >= 0
    votes[row[fired], voter[index[fired]]] = 1
    votes[:, len(lexicon) :] = np.frombuffer(b"".join(sample.column("pattern").to_pylist()), np.uint8).reshape(n, -1)
    post, _ = label_model(votes, gold)
    w, bias = _linear.ftrl(bounds, index, np.ones(len(index), dtype=np.float32), np.stack((1 - post, post), axis=1), len(used), alpha=ALPHA, beta=BETA, l1=L1, l2=L2, epochs=EPOCHS)
    weights[used] = w[:, 1] - w[:, 0]
    return weights, float(bias[1] - bias[0])


def _score(broadcast):  # noqa: ANN001, ANN202
    how = T.table("alnum", "lower")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, weight, bias = broadcast.value
        weights = np.zeros(BUCKETS, dtype=np.float32)
        weights[at] = weight
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, off, raw in T.slices(batch.column("text")):
                row, bucket = _buckets(T.Words(off, raw, how))
                some = weights[bucket] != 0
                row, bucket = T.distinct(row[some], bucket[some])
                out[i : i + len(off) - 1] = np.bincount(row, weights=weights[bucket], minlength=len(off) - 1)
            score = 1 / (1 + np.exp(-np.clip(out + bias, -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= LIMIT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def trained(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE):  # noqa: ANN201
    """A broadcast of the classifier: buckets with a weight, their weights, and the bias (at most BUCKETS entries)."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(~_held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    # labelled doc_ids that the documents have, a bounded number of them
    ids = given.join(docs.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # one of each doc_id, always the same
    rows = chosen.mapInArrow(_features, "doc_id long, toxic int, bucket binary, pattern binary")
    weights, bias = _fit(rows.toArrow().sort_by("doc_id"))
    at = np.flatnonzero(weights)
    return spark.sparkContext.broadcast((at, weights[at], bias))


def toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of documents (doc_id, text, ...).

    held_out: crc32 of doc_id as text leaves 2 modulo 4; labels of those rows teach nothing.  labels has (doc_id, toxic);
    rows without either are ignored, of repeated doc_ids the largest label and the
    smallest text teach.  predicted is 1 from a score of 0.3.
    Null and empty texts get the score of a text without any known word.  With no labels, or labels of one kind, all texts
    get one score.  Repeated rows are scored one by one; an empty table gives an empty result; other columns are ignored.
    """
    model = trained(documents, labels, sample)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", _held_out())
    return docs.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")


def _clean(broadcast):  # noqa: ANN001, ANN202
    score = _score(broadcast)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = pa.nulls(batch.num_rows, pa.int64())
            asked = pa.RecordBatch.from_arrays([none, batch.column("text"), none], names=["doc_id", "text", "held_out"])
            for got in score(iter([asked])):
                yield batch.filter(pa.array(got.column("predicted").to_numpy() == 0))

    return run


def drop_toxic(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of documents that toxicity() does not predict as toxic, with all columns."""
    return documents.mapInArrow(_clean(trained(documents, labels, sample)), documents.schema)
