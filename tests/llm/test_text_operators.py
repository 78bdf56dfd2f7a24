import random

import brute
import pytest

from sluice.llm import decontaminate, minhash_dedup, quality_rules

ODD = [None, "", " \n\t ", "one", "one two three", "One  two\nthree", "a\x00b \x01 c \x02", "É é ñ 日本 語", "x " * 40, "\n\nfoo\n", "foo", "🙂 a b c d e f"]
SCHEMA = "doc_id long, text string, source string, label long, key string"


def rows_of(texts):
    return [(i, t, None if i % 7 == 0 else f"s{i % 2}", 1, "k") for i, t in enumerate(texts)]


def made(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    base = [[rng.choice(vocab) for _ in range(rng.choice([3, 5, 12, 40, 120]))] for _ in range(n)]
    texts = []
    for w in base:
        texts.append(" ".join(w))
        for _ in range(rng.choice([0, 0, 1, 6])):
            v = list(w)
            for _ in range(rng.choice([0, 1, 2, 5])):
                v[rng.randrange(len(v))] = rng.choice(vocab)
            texts.append(" ".join(v) if rng.random() < 0.5 else "\n".join(v))
    shared = " ".join(rng.choice(vocab) for _ in range(60))
    texts += [shared + " " + " ".join(rng.choice(vocab) for _ in range(30)) for _ in range(25)]
    rng.shuffle(texts)
    return texts


def family(n, seed):
    """Copies of one text with edits of their own: many pairs close to the limit."""
    rng = random.Random(seed)
    base = [f"v{rng.randrange(300)}" for _ in range(150)]
    out = []
    for _ in range(n):
        v = list(base)
        for _ in range(rng.choice([2, 3, 4])):
            v[rng.randrange(len(v))] = f"u{rng.randrange(1000)}"
        out.append(" ".join(v))
    return out


@pytest.mark.parametrize("texts", [ODD + made(60, 1), family(400, 2)], ids=["mixed", "family"])
def test_near_duplicates(spark, texts, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "FULL_BLOCK", 64)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()}
    assert got == brute.near_duplicates([(i, t) for i, t in enumerate(texts)])


def test_near_duplicates_edges(spark):
    t = "a b c d e f g h"
    df = spark.createDataFrame([(5, t, "s", 1, "k"), (5, t, "s", 1, "k"), (3, t, "s", 1, "k"), (None, t, "s", 1, "k"), (9, None, "s", 1, "k")], SCHEMA)
    got = sorted(minhash_dedup.near_duplicates(df).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True), (None, None, True)]
    assert sorted(r.doc_id for r in minhash_dedup.drop_near_duplicates(df).collect() if r.doc_id) == [3, 9]
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1 << 24, 200])
def test_contamination(spark, block):
    texts = ODD + made(40, 3)
    rng = random.Random(5)
    items = [(k, t) for k, t in enumerate([None, "", "w1 w2 w3", "w5"] + [" ".join(t.split()[rng.randrange(3) :][:20]) for t in texts if t and len(t) > 80][:8])]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench, block_bytes=block).collect()
    want = brute.contamination([(i, t) for i, t in enumerate(texts)], items)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(want)
    assert all((r.longest_match > 0) == (r.n_hit > 0) for r in got)
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(r[0] for r in want if not r[5])
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_longest_match_is_the_same_for_every_block_count(spark):
    words = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(words[at : at + 20])) for k, at in ((5, 0), (7, 26), (9, 26), (11, 40))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows_of([" ".join(words), " ".join(words[26:]), "none of them"]), SCHEMA)
    got = [sorted((r.doc_id, r.longest_match, r.longest_item or "", r.longest_at) for r in decontaminate.contamination(docs, bench, block_bytes=b).collect()) for b in (1 << 24, 150)]
    assert [x[1:] for x in got[0]] == [(20, "5", 0), (20, "7", 0), (0, "", -1)] and all(g == got[0] for g in got)


def test_base_rules(spark):
    texts = ODD + made(30, 4) + ["\n".join(["same line here"] * 30 + ["other", "same line here "]), "# * a b c a b c $ a b c\n" * 3 + "é 🙂"]
    got = quality_rules.quality(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted(brute.base_rules(list(enumerate(texts))))
    assert quality_rules.quality(spark.createDataFrame([], SCHEMA)).count() == 0


def test_common_lines_deplete(spark):
    rng = random.Random(1)
    body = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    boiler = body(60)
    rows = [(i, f"{boiler}\n{body(10)}" if i < 30 else body(70), "h", 1, "k") for i in range(100)]
    rows += [(200 + i, body(70) if i == 0 else rows[99][1], "h", 1, "k") for i in range(50)]
    got = {r.doc_id: r.kept for r in quality_rules.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i for i, kept in got.items() if not kept} == set(range(30))


def test_common_lines_of_a_large_host(spark):
    rng = random.Random(2)
    body = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    boiler = body(60)
    rows = [(i, f"{boiler}\n{body(10)}" if i < 30 else body(70), "h", 1, "k") for i in range(600)]
    got = {r.doc_id: r.kept for r in quality_rules.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i for i, kept in got.items() if not kept} == set(range(30))


def test_templated_pages_count_one_by_one(spark):
    body = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    rows = [(i, f"Order {i} shipped on {i % 28} May\n{body}", "h", 1, "k") for i in range(10, 40)]
    rows += [(100 + i, f"{body} {body[::-1]} copy", "h", 1, "k") for i in range(30)]
    got = {r.doc_id: r.kept for r in quality_rules.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i for i, kept in got.items() if not kept} == set(range(10, 40))


def test_common_lines_of_a_small_host(spark):
    """A host of few documents has its common lines, too; their numbers are told, and the texts are returned without them."""
    rng = random.Random(3)
    body = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    boiler, foot = body(60), "All rights reserved 2024"
    rows = [(i, f"{body(70)}\n\n{boiler}\n{foot.replace('2024', str(2000 + i))}\n" if i < 4 else f"{boiler}\n{body(10)}" if i == 4 else body(70) + "\n", None, 7, "k") for i in range(7)]
    rows += [(100 + i, f"{boiler}\n{body(70)}" if i < 2 else body(70), "other", 7, "k") for i in range(4)]
    rows += [(200, rows[0][1], "other", 7, "k"), (300, None, None, 7, "k"), (301, rows[1][1], None, 7, "k")]
    docs = spark.createDataFrame([(i, t, s, n, g) for i, t, s, n, g in rows], "doc_id long, text string, source string, host int, gone string")
    got = {r.doc_id: (r.removed_lines, r.removed_words, r.kept) for r in quality_rules.quality(docs).collect()}
    plain = lambda r: ([], 0, r[1] is not None)
    want = {r[0]: plain(r) for r in rows} | {i: ([2, 3], 64, True) for i in (0, 1, 2, 3, 301)} | {4: ([0], 60, False)}
    want |= {i: ([at], 60, True) for i, at in ((100, 0), (101, 0), (200, 2))}
    assert got == want
    texts = {r[0]: "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in want[r[0]][0]) for r in rows if want[r[0]][2]}
    left = quality_rules.clean(docs)
    assert left.columns == docs.columns and sorted(map(tuple, left.collect()), key=lambda r: r[0]) == sorted(((r[0], texts[r[0]], *r[2:]) for r in rows if r[0] in texts), key=lambda r: r[0])
    assert quality_rules.clean(docs.limit(0)).count() == 0
