"""Connected components against a plain union-find."""

import hashlib
import random

import pytest

from sluice.llm import _jobs, line_dedup, minhash_dedup


def _plain(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("hot", [2, 256])
def test_components(spark, monkeypatch, hot):
    """Chains, stars around a large and a small node, repeats and loops, with and without nodes taken as hot."""
    monkeypatch.setattr(_jobs, "HOT_DEGREE", hot)
    r = random.Random(hot)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(150)] + [(i, i + 1) for i in range(500, 530)] + [(9, 9), (7, 8), (7, 8)]
    edges += [(999, i) for i in range(600, 900, 2)] + [(1, i) for i in range(601, 900, 2)]
    got = _jobs.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({x.node for x in got})
    assert {x.node: x.component for x in got} == _plain(edges)


def test_no_edges(spark):
    assert _jobs.components(spark.createDataFrame([(3, 3), (None, 1)], "a long, b long")).isEmpty()


def moved_bytes(spark):
    sc, jvm = spark.sparkContext, spark._jvm
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


@pytest.mark.parametrize("drop", [line_dedup.dedup_lines, minhash_dedup.drop_near_duplicates])
def test_texts_that_stay_do_not_move(spark, drop):
    """Where the table of changes is too large to be broadcast, only the texts that may change are shuffled."""
    words = lambda k: [hashlib.md5(f"{k} {j}".encode()).hexdigest() for j in range(40)]
    text = lambda k: "\n".join(" ".join(words(k)[j : j + 8]) for j in range(0, 40, 8))
    rows = [(k, text(k), 1, "a") for k in range(300)] + [(1000, text(7), 2, "b"), (1001, text(8) + "\none line more", 3, "c"), (None, text(9), 4, "d"), (1002, None, 5, "e"), (1003, "", 6, "f")]
    rows += [(1004, text(400), 7, "g"), (1004, text(400), 7, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at int, `row` string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = drop(docs)
        moved = moved_bytes(spark)
        got = out.collect()
        moved = moved_bytes(spark) - moved
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = drop is line_dedup.dedup_lines
    want = rows[:300] + [(1001, "one line more" if lines else None, 3, "c")] * lines + rows[302:305] + rows[305 : 307 if lines else 306]
    assert out.columns == docs.columns and sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert moved < sum(len(r[1] or "") for r in rows) / 10
