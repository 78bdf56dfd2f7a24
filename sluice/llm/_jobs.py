"""Job plumbing: shared scratch tables, table readers, sieves, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import scratch, written

__all__ = ["components", "parted", "read", "scratch", "small_batches", "written"]

BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch, as rows are whole texts: a worker holds a few megabytes of them at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SIEVE_WORDS = 1 << 20  # a power of two


def sieve(keys: DataFrame, key: Column) -> tuple[DataFrame, Column, Column]:
    """(table of word and bits, the word of a key, its bit): bits of the hashed keys, a table of at most SIEVE_WORDS rows to be broadcast."""
    word, bit = key.bitwiseAND(F.lit(SIEVE_WORDS - 1)), F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(key, 58).cast("int"))
    return keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")), word, bit


def parted(rows: DataFrame, at: str, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose column at may be among keys, rows where it is not), so that the latter, as a rule most, need not move for a join.

    The first have all rows with such a key, and few others as long as the sieve is not full.
    """
    bits = written(sieve(keys.where(F.col(key).isNotNull()), F.xxhash64(key))[0].withColumnsRenamed({"word": "__word", "bits": "__bits"}))
    _, word, bit = sieve(rows, F.xxhash64(at))
    hit = F.col("__bits").bitwiseAND(bit) != 0
    known = rows.join(F.broadcast(bits), word == F.col("__word"), "left")
    names = [F.col(f"`{c}`") for c in rows.columns]
    return known.where(hit).select(*names), known.where(~F.coalesce(hit, F.lit(False))).select(*names)


HOT_DEGREE, MOST_HOT = 256, 2000


def _with_least(rows: DataFrame, least: DataFrame, key: str, most: int, total: int) -> DataFrame:
    """rows with m, the least value of their key, from least (key, m, n); n rows have the key, at most ``most`` of ``total``.

    The least values of keys with very many rows are broadcast, so that these rows stay where they are; as such a key has over
    total / MOST_HOT of all rows, there are at most MOST_HOT.  Without such keys a plain join does the same.
    """
    limit, every = max(HOT_DEGREE, total // MOST_HOT), least.select(key, "m")
    if most <= limit:
        return rows.join(every, key)
    hot = F.broadcast(least.where(F.col("n") > limit).select(key, "m"))
    return rows.join(hot.select(key), key, "left_anti").join(every, key).unionByName(rows.join(hot, key))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node reachable.

    Alternating large-star and small-star steps, until every node has one smaller neighbour or none, and then no larger ones beside it.
    One partial aggregate a round gives each node's least neighbour, its degrees and whether that is so; least values of nodes
    with very many neighbours go by broadcast, so that no such node is a hot task, and the driver gets only counts.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    side = lambda node, other, up: e.select(F.col(node).alias("node"), F.col(other).alias("other"), F.lit(up).alias("up"))
    for _ in range(most_rounds):
        ends = side("hi", "lo", 1).union(side("lo", "hi", 0))
        nodes = written(ends.groupBy("node").agg(F.min("other").alias("m"), F.count("*").alias("n"), F.sum("up").alias("up")))
        open_ = ((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("n") > 1))).cast("int")
        unsettled, most, most_up, total = nodes.agg(F.max(open_), F.max("n"), F.max("up"), F.sum("up")).first()
        if not unsettled:
            return nodes.select("node", F.when(F.col("up") == 1, F.col("m")).otherwise(F.col("node")).alias("component"))
        large = _with_least(e, nodes.withColumnRenamed("node", "lo"), "lo", most, 2 * total)
        large = written(large.select("hi", F.least("lo", "m").alias("lo")))
        least = written(large.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n")))
        both = _with_least(large, least, "hi", most_up, total)  # the least ones themselves, and the others under them
        e = written(both.select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo")).distinct())
    raise RuntimeError("components did not settle")
