"""Quality rules: base rules per document and cross-document line frequency per host.

Normalised lines (lower case, digits as 0, words joined) are hashed.  For each host the documents that hold a line are counted,
documents with equal texts counting once, so that copies of one document make no line common.  Lines in at
least so many documents are removed, however large the host, and in a host of few documents those in at least half of them; a
document left with too little of itself is rejected.  ``quality`` tells the lines removed, ``clean`` takes them out of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._jobs import written

MIN_WORDS = 50
REPEAT_PERCENT = 50
LINE_MIN_DOCS = 20
HOST_PERCENT, HOST_MIN_DOCS = 50, 3  # of a host with few documents: so many of them, and so many at least
SALTS = 32
DEPLETED_PERCENT = 50

_SCHEMA = "doc_id long, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, fp long, lines array<long>, line_words array<int>, line_nos array<int>"
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_NOT_CONTINUED = (np.arange(256) & 0xC0) != 0x80


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    plain, normal = T.table("space"), T.table("space", "line")
    mult = T.seeds(1, 61)[0] | T.U64(1)
    inverse = T.U64(pow(int(mult), -1, 1 << 64))
    for batch in batches:
        for i, off, raw in T.slices(batch.column("text")):
            rows = len(off) - 1
            w = T.Words(off, raw, plain)
            row_of = lambda pos: np.searchsorted(off, pos, "right") - 1  # noqa: B023, E731
            chars = np.concatenate(([0], np.cumsum((plain[raw] != 0) & _NOT_CONTINUED[raw])))
            symbols = np.concatenate(([0], np.cumsum(_SYMBOLS[raw])))
            # words in repeated windows of three
            row, first, h = T.grams(w, 3)
            order = np.lexsort((h, row))
            r, v = row[order], h[order]
            twice = np.zeros(len(r), dtype=bool)
            same = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
            twice[1:] |= same
            twice[:-1] |= same
            covered = np.zeros(len(w), dtype=bool)
            at = first[order[twice]]
            for j in range(3):
                covered[at + j] = True
            repeated = np.bincount(w.row[covered], minlength=rows)
            # lines: [begin, end) between newlines and document bounds
            breaks = np.flatnonzero(raw == 10)
            full = np.flatnonzero(np.diff(off) > 0)
            begin = np.sort(np.concatenate((off[full], breaks + 1)))
            end = np.sort(np.concatenate((off[full + 1], breaks)))
            line_of = np.searchsorted(begin, w.start, "right") - 1
            n_in = np.bincount(line_of, minlength=len(begin))
            has = np.flatnonzero(n_in)
            begin, end, n_in = begin[has], end[has], n_in[has]
            line_row = row_of(begin)
            prefix, ipow = T.prefix_sums(raw)
            exact = T.range_hash(prefix, ipow, begin, end)
            kinds = T.distinct(line_row, exact)[0]
            dup = np.bincount(line_row, minlength=rows) - np.bincount(kinds, minlength=rows)
            # normalised lines: a polynomial over the words' normalised hashes
            nprefix, nipow = T.prefix_sums(normal[raw])
            word = T.range_hash(nprefix, nipow, w.start, w.end)
            m = len(w)
            pw, ipw = np.ones(m + 1, dtype=T.U64), np.ones(m + 1, dtype=T.U64)
            np.multiply.accumulate(np.full(m, mult), out=pw[1:])
            np.multiply.accumulate(np.full(m, inverse), out=ipw[1:])
            sums = np.concatenate((np.zeros(1, T.U64), np.cumsum(word * pw[:m])))
            stop = np.cumsum(n_in)
            start = stop - n_in
            norm = T.mix((sums[stop] - sums[start]) * ipw[start] + n_in.astype(T.U64))
            number = np.searchsorted(breaks, begin) - np.searchsorted(breaks, off[line_row])
            bounds = np.concatenate(([0], np.cumsum(np.bincount(line_row, minlength=rows))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(i, rows),
                    batch.column("source").slice(i, rows),
                    *(pa.array(x, pa.int64()) for x in (w.counts, chars[off[1:]] - chars[off[:-1]], symbols[off[1:]] - symbols[off[:-1]], dup, repeated)),
                    batch.column("fp").slice(i, rows),
                    T.list_of(norm.view(np.int64), bounds, pa.int64()),
                    T.list_of(n_in.astype(np.int32), bounds, pa.int32()),
                    T.list_of(number.astype(np.int32), bounds, pa.int32()),
                ],
                names=[x.split()[0] for x in _SCHEMA.split(", ")],
            )


def _host_limits(once: DataFrame, line_min_docs: int) -> DataFrame:
    """(host, salt, least): the limit of the hosts of so few documents that it is under line_min_docs, once for each salt."""
    hosts = once.groupBy("source").agg(F.count("*").alias("docs"))
    share = F.ceil(F.col("docs") * HOST_PERCENT / F.lit(100)).cast("long")
    hosts = hosts.select(F.col("source").alias("host"), F.greatest(share, F.lit(HOST_MIN_DOCS)).alias("least")).where(F.col("least") < line_min_docs)
    return hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _judged(documents: DataFrame, line_min_docs: int, depleted_percent: int) -> DataFrame:
    """The columns of quality, and source and fp (hash of the text), which decide all of them but doc_id."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"))
    base = written(docs.withColumn("fp", F.xxhash64("text")).mapInArrow(_measure, _SCHEMA).withColumn("row", F.monotonically_increasing_id()))
    once = base.select("source", "fp", F.array_distinct("lines").alias("lines")).where(F.size("lines") > 0)
    once = written(once.groupBy("source", "fp").agg(F.first("lines").alias("lines")))
    counts = once.select("source", F.explode("lines").alias("line")).groupBy("source", "line").agg(F.count("*").alias("docs"))
    counts = written(counts.where(F.col("docs") >= min(HOST_MIN_DOCS, line_min_docs)))
    few = _host_limits(once, line_min_docs)
    salted = counts.where(F.col("docs") < line_min_docs).withColumn("salted", F.pmod("line", F.lit(SALTS)).cast("int"))  # so that no host is one task
    of_few = salted.join(few, salted["source"].eqNullSafe(few["host"]) & (salted["salted"] == few["salt"])).where(F.col("docs") >= F.col("least"))
    common = counts.where(F.col("docs") >= line_min_docs).select("source", "line").unionByName(of_few.select("source", "line"))
    common = written(common.select(F.col("source").alias("host"), "line"))
    each = base.select("row", "source", F.explode(F.arrays_zip("lines", "line_words", "line_nos")).alias("x"))
    each = each.select("row", "source", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"), F.col("x.line_nos").alias("line_no"))
    gone = each.join(common, (each["line"] == common["line"]) & each["source"].eqNullSafe(common["host"]), "left_semi")
    gone = gone.groupBy("row").agg(F.sum("words").alias("removed_words"), F.sort_array(F.collect_list("line_no")).alias("removed_lines"))
    return (
        base.drop("lines", "line_words", "line_nos")
        .join(gone, "row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
        .withColumn("removed_lines", F.coalesce("removed_lines", F.expr("cast(array() as array<int>)")))
        .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words"))
        .withColumn("kept", F.expr(f"not base_failed and 100 * (n_words - removed_words) >= {depleted_percent} * n_words"))
    )


def quality(documents: DataFrame, line_min_docs: int = LINE_MIN_DOCS, depleted_percent: int = DEPLETED_PERCENT) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words, removed_lines, kept) for every row.

    The host is ``source`` (null is a host of its own).  A line is removed where it stands in at least
    ``line_min_docs`` documents of the host, documents with equal texts counting once; where half of the host's documents that have lines (HOST_PERCENT,
    and HOST_MIN_DOCS at least) are fewer, so many are enough.  removed_lines are the numbers of the text's lines removed, from 0.  A document
    is kept unless base_failed (under 50 words, or more than half of
    its words in repeated 3-word windows), or unless removal leaves less than ``depleted_percent`` percent of its words.
    Null, empty and blank texts have no words and fail the base rule.  Repeated rows are judged one by one; an empty
    table gives an empty result; other columns are ignored.
    """
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "removed_lines", "kept")
    return _judged(documents, line_min_docs, depleted_percent).select(*names)


def clean(documents: DataFrame, line_min_docs: int = LINE_MIN_DOCS, depleted_percent: int = DEPLETED_PERCENT) -> DataFrame:
    """The rows of documents that are kept, their texts without the removed lines; all columns stay, whatever their names."""
    judged = _judged(documents, line_min_docs, depleted_percent).where("kept").groupBy("source", "fp").agg(F.first("removed_lines").alias("gone"))
    judged = written(judged.select(F.col("source").alias("host"), "fp", "gone"))
    own = documents.select(F.col("source").cast("string").alias("of"), F.xxhash64("text").alias("at"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    joined = own.join(judged, own["of"].eqNullSafe(judged["host"]) & (own["at"] == judged["fp"]))
    left = F.array_join(F.filter(F.split(F.col("row")["text"], "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.size("gone") == 0, F.col("row")["text"]).otherwise(left)
    return joined.select(*[(text if c == "text" else F.col("row")[c]).alias(c) for c in documents.columns])
