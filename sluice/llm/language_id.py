"""Language identification: sparse multinomial logistic regression on TF-IDF of hashed character n-grams.

Character n-grams of lengths 1 to 3 over lower-cased letters (all else is a space) are hashed to FEATURES buckets.  Document
frequencies are counted over every training document; the model is fitted on a bounded sample of them (``sample``
documents with the smallest hash of doc_id) with follow-the-regularised-leader and an elastic-net penalty, and a
fifth of the sample sets the temperature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _linear
from . import _text as T

FEATURES = 1 << 14
SAMPLE = 6000
L1, L2 = 2e-4, 1e-5
_ROWS = 128  # of a dense count table

_tables: list[np.ndarray] = []


def _fold() -> tuple[np.ndarray, np.ndarray]:
    """code point -> whether it is a letter; -> the code point that it counts as."""
    if not _tables:
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        low = np.where(letter, np.arange(0x110000), 32)
        for c in np.flatnonzero(letter[:0x2000]):
            if len(x := chr(c).lower()) == 1:
                low[c] = ord(x)
        _tables.extend((letter, low.astype(np.uint64)))
    return _tables[0], _tables[1]


def _counts(arr: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, has a letter, row, feature, count) for slices; row and feature ascend."""
    letter, low = _fold()
    mult = T.seeds(4, 71) | T.U64(1)
    for i, off, raw in T.slices(arr):
        code = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[off]
        all_row = np.repeat(np.arange(len(off) - 1), np.diff(at))
        has = np.bincount(all_row[letter[code]], minlength=len(off) - 1) > 0
        low_code = low[code]
        for k in range(0, len(off) - 1, _ROWS):
            rows = min(_ROWS, len(off) - 1 - k)
            c, row = low_code[at[k] : at[k + rows]], all_row[at[k] : at[k + rows]] - k
            table = np.zeros(rows * FEATURES, dtype=np.int32)
            for n in (1, 2, 3):
                m = len(c) - n + 1
                if m <= 0:
                    continue
                h = np.full(m, mult[n])
                for j in range(n):
                    h = (h ^ c[j : j + m]) * mult[0]
                    h ^= h >> T.U64(29)
                bucket = (h >> T.U64(20)).astype(np.int64) % FEATURES
                ok = row[:m] == row[n - 1 :]
                table += np.bincount(row[:m][ok] * FEATURES + bucket[ok], minlength=len(table)).astype(np.int32)
            found = np.flatnonzero(table)
            yield i + k, rows, has[k : k + rows], found // FEATURES, found % FEATURES, table[found]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(FEATURES + 1, dtype=np.int64), 0
    for batch in batches:
        for _, rows, _, _, feature, _ in _counts(batch.column("text")):
            df[:FEATURES] += np.bincount(feature, minlength=FEATURES)
            docs += rows
    df[FEATURES] = docs
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["feature", "docs"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, rows, has, row, feature, count in _counts(batch.column("text")):
            bounds = np.searchsorted(row, np.arange(rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, rows), batch.column("lang").slice(i, rows), pa.array(has), T.binary_of(feature.astype(np.uint16), bounds), T.binary_of(count.astype(np.int32), bounds)],
                names=["doc_id", "lang", "has", "feature", "count"],
            )


def _weighted(row: np.ndarray, feature: np.ndarray, count: np.ndarray, rows: int, idf: np.ndarray) -> np.ndarray:
    value = np.log1p(count) * idf[feature]
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=rows))
    return value / np.maximum(norm, 1e-9)[row]


def _fit(sample: pa.Table, idf: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    sample = sample.filter(sample.column("has"))
    langs = sample.column("lang").to_pylist()
    names = sorted(set(langs))
    if not names:
        return [], np.zeros((FEATURES, 0)), np.zeros(0), 1.0
    feature = [np.frombuffer(x, np.uint16).astype(np.int64) for x in sample.column("feature").to_pylist()]
    count = [np.frombuffer(x, np.int32) for x in sample.column("count").to_pylist()]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in feature])))
    feature, count = np.concatenate(feature), np.concatenate(count)
    value = _weighted(np.repeat(np.arange(len(langs)), np.diff(bounds)), feature, count, len(langs), idf)
    label = np.array([names.index(x) for x in langs])
    target = np.eye(len(names))[label]
    cut = lambda rows: (np.concatenate(([0], np.cumsum(np.diff(bounds)[rows]))), np.concatenate([np.arange(bounds[r], bounds[r + 1]) for r in rows]) if len(rows) else np.zeros(0, np.int64))
    held = np.flatnonzero(np.arange(len(langs)) % 5 == 4)
    fit = np.flatnonzero(np.arange(len(langs)) % 5 != 4)
    b, at = cut(fit)
    w, bias = _linear.ftrl(b, feature[at], value[at], target[fit], FEATURES, alpha=1.0, l1=L1, l2=L2)
    b, at = cut(held)
    t = _linear.temperature(_linear.scores(b, feature[at], value[at], w, bias), label[held]) if len(held) else 1.0
    return names, w, bias, t


def _predict(broadcast):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, w, bias, t, idf = broadcast.value
        for batch in batches:
            for i, rows, has, row, feature, count in _counts(batch.column("text")):
                lang, score = [None] * rows, np.zeros(rows)
                if names:
                    value = _weighted(row, feature, count, rows, idf)
                    p = _linear.softmax(_linear.scores(np.searchsorted(row, np.arange(rows + 1)), feature, value, w, bias) / t)
                    lang, score = [names[k] for k in p.argmax(axis=1)], np.where(has, p.max(axis=1), 0)
                lang = [x if ok and x is not None else "und" for x, ok in zip(lang, has)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, rows), batch.column("held_out").slice(i, rows), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of documents (doc_id, text, lang, ...).

    held_out: crc32 of doc_id as text leaves 1 modulo 3; those rows, rows without doc_id and rows without lang teach nothing.
    A null text, or one without a letter, gives ``und`` with score 0, as does every text if there is nothing to learn from.
    Repeated rows are judged one by one, and of a repeated doc_id the row with the smallest (lang, text) is in the sample; an empty
    table gives an empty result; columns but doc_id, text and lang are ignored.
    """
    spark = documents.sparkSession
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).withColumn("held_out", F.coalesce(fold == 1, F.lit(False)))
    train = docs.where("not held_out and doc_id is not null and lang is not null and text is not null")
    freq = train.select("text").mapInArrow(_frequencies, "feature int, docs long").groupBy("feature").agg(F.sum("docs").alias("docs")).toPandas()
    df = np.zeros(FEATURES + 1)
    df[freq["feature"].to_numpy()] = freq["docs"].to_numpy()
    idf = np.log((1 + df[FEATURES]) / (1 + df[:FEATURES])) + 1
    ids = train.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).distinct()
    chosen = train.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("one")).select("doc_id", "one.lang", "one.text")
    rows = chosen.mapInArrow(_features, "doc_id long, lang string, has boolean, feature binary, count binary")
    table = rows.toArrow().sort_by("doc_id")
    names, w, bias, t = _fit(table, idf)
    model = spark.sparkContext.broadcast((names, w.astype(np.float32), bias, t, idf))
    return docs.select("doc_id", "text", "held_out").mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
