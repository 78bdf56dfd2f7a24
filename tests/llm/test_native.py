import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from sluice.llm import chat_rotation, line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        k, p = rng.randrange(3), rng.randrange(len(s) + 1)
        if k == 0:
            s.insert(p, rng.choice("abcdé "))
        elif p < len(s):
            if k == 1:
                del s[p]
            else:
                s[p] = rng.choice("abcdé🙂")
    return "".join(s)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_edit_distance(spark, threshold):
    rng = random.Random(threshold)
    rows = []
    while len(rows) < 300:
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(4, 30)))
        b = edited(rng, a, rng.randrange(6))
        if abs(len(a) - len(b)) <= threshold and len(b) > threshold:
            rows.append((a, b))
    df = spark.createDataFrame(rows, "a string, b string")
    chars = lambda c: F.split(c, "")
    for r in df.select("a", "b", line_dedup.edit_distance(chars("a"), chars("b"), threshold).alias("d")).collect():
        true = distance(r.a, r.b)
        assert r.d == true if true <= threshold else r.d > threshold, (r, true)


def plain_classes(rows, threshold, min_chars, fuzzy):
    lines = [(i, k, x.strip(" \t\r")) for i, t in rows if i is not None and t is not None for k, x in enumerate(t.split("\n"))]
    lines = sorted({x for x in lines if len(x[2]) >= min_chars})
    texts = sorted({x[2] for x in lines})
    links = {t: set() for t in texts}
    long = [t for t in texts if len(t) >= fuzzy]
    for i, a in enumerate(long):
        for b in long[:i]:
            if abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold:
                links[a].add(b)
                links[b].add(a)
    first, seen = {}, set()
    for i, k, t in lines:
        if t in seen:
            continue
        todo = [t]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                first[x] = (i, k)
                todo += links[x]
    return [(i, k, *first[t], len(links[t]), (i, k) == first[t]) for i, k, t in lines]


def copied(text, left, min_chars):
    return not any(x.strip(" \t\r") for x in left.split("\n"))


def texts(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([3, 10, 18, 24, 31, 60]))) for _ in range(25)]
    out = [None, "", "\n \n", "   "]
    for _ in range(60):
        out.append("\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 4])) for _ in range(rng.randrange(1, 5))))
    return out


@pytest.mark.parametrize("threshold", [1, 2])
def test_line_classes(spark, threshold):
    rows = list(enumerate(texts(threshold)))
    rows.append(rows[20])
    df = spark.createDataFrame([(i, t, "k", 7) for i, t in [*rows, (None, rows[9][1])]], "doc_id long, text string, key string, h int")
    got = line_dedup.line_classes(df, threshold=threshold, min_chars=8, fuzzy_chars=12).distinct().collect()
    assert sorted((r.doc_id, r.line_no, r.class_doc_id, r.class_line_no, r.n_links, r.kept) for r in got) == plain_classes(rows, threshold, 8, 12)
    assert line_dedup.line_classes(df.limit(0)).count() == 0
    left = line_dedup.dedup_lines(df, threshold=threshold, min_chars=8, fuzzy_chars=12)
    assert left.columns == df.columns
    gone = {(i, k) for i, k, *_, kept in plain_classes(rows, threshold, 8, 12) if not kept}
    want = []
    for i, t in [*rows, (None, rows[9][1])]:
        keep = t if t is None or i is None or not any((i, k) in gone for k in range(99)) else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
        if keep is t or not copied(t, keep, 8):
            want.append((i, keep))
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=str) == sorted(want, key=str)


def test_perspectives(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "bob", "é🙂"), (1, None, "ann", "first"), (1, 700, None, "x"), (2, 0, "system", "only"), (None, 0, "ann", "lost"), (3, 0, "eve", "a"), (3, 0, "eve", "a")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, start string")
    got = chat_rotation.perspectives(df, block=2).collect()
    assert chat_rotation.perspectives(df.limit(0)).count() == 0
    want = set()
    for conv in (1, 2, 3):
        turns = sorted([(t is not None, t or 0, r or "unknown", x or "", t) for c, t, r, x in rows if c == conv])
        for p in {t[2] for t in turns} - {"system"}:
            text = ""
            for _, _, who, x, turn in sorted(turns, key=lambda t: (t[0], t[1], t[2], t[3])):
                head = "<|assistant|>\n" if who == p else "<|system|>\n" if who == "system" else f"<|user:{who}|>\n"
                seg = head + x + "<|end|>\n"
                want.add((conv, p, turn, who, seg, len(text), len(text) + (len(head) if who == p else 0), len(text) + (len(seg) if who == p else 0)))
                text += seg
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_urls(spark):
    from sluice.llm import url_filter

    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/71?x#y", "x://example.com/en/8", "x://badcom/en/8", "x://com/en/", "x://a.net/de/8", "x://example.net/de/81/", "x://q.example.net/de/9", "x://org/es/", "x://a.org?q=/es/", "x://a.org/es", "http://a://b/c"]
    rows = [(k, u, "h") for k, u in enumerate(urls)]
    rows += [(100 + k, f"http://mix.com/{'en' if k < 95 else 'us'}/page-{k}", "h") for k in range(100)]
    rows += [(300 + k, f"http://mix.org/fr/{k}", "h") for k in range(100)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, host string, n string")
    got = {r.page_id: r for r in url_filter.judged(df).collect()}
    assert len(got) == len(rows)
    want = [("", "", None), ("", "", None), ("", "", None), ("", "", None), ("a.example.com", "/en/71", "example.com/en/7"), ("example.com", "/en/8", "com/en/"), ("badcom", "/en/8", None), ("com", "/en/", "com/en/"), ("a.net", "/de/8", "net/de/"), ("example.net", "/de/81/", "example.net/de/8"), ("q.example.net", "/de/9", "net/de/"), ("org", "/es/", "org/es/"), ("a.org", "", None), ("a.org", "/es", None), ("a:", "//b/c", None)]
    assert [(got[k].host, got[k].path, got[k].rule) for k in range(len(urls))] == want
    assert [got[k].verdict for k in range(4, 14)] == ["allow", "block", "allow", "block", "allow", "block", "allow", "block", "allow", "allow"]
    assert {got[k].verdict for k in range(100, 200)} == {"block"}  # /us/ pages are spread like the blocked branch
    assert {got[k].verdict for k in range(300, 400)} == {"allow"}
    assert url_filter.judged(df.limit(0)).count() == 0


def test_limits_by_length(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWD", 5)
    monkeypatch.setattr(line_dedup, "BLOCK", 3)
    monkeypatch.setattr(line_dedup, "LONG_CHARS", 100)
    limits = ((12, 1), (30, 2), (60, 4))
    monkeypatch.setattr(line_dedup, "LIMITS", limits)
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (14, 28, 29, 31, 45, 58, 59, 60, 61, 62, 80, 150)]
    lines = sorted({edited(rng, b, rng.randrange(7)) for b in base for _ in range(25)} | {"ab" * 40, "ab" * 41, "ba" * 40, "ab" * 42 + "c"})
    df = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    limit = lambda n: max((t for least, t in limits if n >= least), default=0)
    near = {(i, j): distance(a, b) for j, b in enumerate(lines) for i, a in enumerate(lines[:j]) if abs(len(a) - len(b)) <= 4}
    want = {p for p, d in near.items() if d <= limit(min(len(lines[p[0]]), len(lines[p[1]])))}
    got = line_dedup.line_links(df).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)
    assert any(near[p] == 4 for p in want) and any(near[p] == 2 for p in want)


def test_changed_words_are_linked(spark):
    line = " ".join(f"word{k}" for k in range(50))  # 339 characters
    rows = [(1, line), (2, line.replace("word17", "word58"))]
    got = line_dedup.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_doc_id, r.kept) for r in got) == [(1, 1, True), (2, 1, False)]


def test_short_lines_take_part(spark):
    rows = [(1, "Les.\n\nnumber 1 of short lines"), (2, "Les.\t\nx\n \n"), (3, "x\nnumber 2 of short lines")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.line_classes(df).collect()
    assert sorted((r.doc_id, r.line_no, r.class_doc_id, r.class_line_no, r.n_links, r.kept) for r in got) == [(1, 0, 1, 0, 0, True), (1, 2, 1, 2, 1, True), (2, 0, 1, 0, 0, False), (2, 1, 2, 1, 0, True), (3, 0, 2, 1, 0, False), (3, 1, 1, 2, 1, False)]
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == {1: rows[0][1], 2: "x\n \n"}


def test_deep_paths(spark):
    from sluice.llm import url_filter

    rules = (("block", "deep.com", "/2024/05/12/casino/a"), ("allow", "deep.com", "/2024/05/12/news/a"))
    urls = [f"http://deep.com/2024/05/12/{'casino' if k % 2 else 'news'}/{'a' if k < 180 else 'b'}{k}" for k in range(200)]
    wide = [f"http://wide.com/a/b/c/d/{chr(97 + k // 26)}{chr(97 + k % 26)}/{'x' if k < 90 else 'y'}/end" for k in range(100)]
    rules += tuple(("block", "wide.com", "/a/b/c/d/" + u.split("/")[-3] + "/x") for u in wide)
    df = spark.createDataFrame(list(enumerate([*urls, *wide])), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judged(df, rules).collect()}
    assert [got[k] for k in range(200)] == ["block" if k % 2 and k < 180 else "allow" for k in range(200)]
    assert [got[k] for k in range(200, 300)] == ["block"] * 90 + ["allow"] * 10


def test_deep_wildcards(spark):
    from sluice.llm import url_filter

    names = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(100)]
    rules = tuple(("block", "wide.com", f"/a/b/c/d/{x}/end") for x in names[:95])
    df = spark.createDataFrame([(k, f"http://wide.com/a/b/c/d/{x}/end") for k, x in enumerate(names)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judged(df, rules).collect()} == {"block"}


def test_line_dedup_of_one_very_common_half(spark):
    """Many lines that share one half: dealt anew by further segments, and in blocks."""
    rows = [(k, "Copyright notice of the common kind by " + hashlib.md5(str(k // 2).encode()).hexdigest() + "xy"[k % 2]) for k in range(3_000)]
    got = line_dedup.line_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.where("kept").count() == 1_500


def test_line_dedup_keeps_columns_that_clash(spark):
    df = spark.createDataFrame([(1, "one line of text here", 7, "a", "b"), (2, "one line of text here\nanother one", 8, "c", "d")], "doc_id long, text string, left int, gone string, `row` string")
    out = {tuple(r) for r in line_dedup.dedup_lines(df).collect()}
    assert out == {(1, "one line of text here", 7, "a", "b"), (2, "another one", 8, "c", "d")}


def test_line_dedup_equals_its_sql(spark, tmp_path):
    """Lines two edits apart, and edits of letters beyond ASCII, which the SQL counts in bytes."""
    import duckdb

    from sluice.llm import queries

    rng = random.Random(11)
    base = ["".join(rng.choice("abcdéè🙂 ") for _ in range(n)) for n in (15, 16, 17, 40, 41, 100, 1100)] + ["".join(rng.choice("abcd ") for _ in range(n)) for n in (16, 45, 120)]
    lines = [edited(rng, b, e) for b in base for e in (0, 1, 1, 1, 2, 2, 3)]
    lines += [b.replace("é", c, 1) for b in base for c in ("e", "è", "ée")] + [b + c for b in base for c in "x🙂"]
    rng.shuffle(lines)
    rows = [(k, "\n".join(lines[3 * k : 3 * k + 3])) for k in range(len(lines) // 3 + 1)] + [(None, base[3]), (900, None), (901, ""), (902, " \n\t\r"), (3, base[4] + "\r")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(queries.oracle_sql()["op1_line_dedup"]).fetchall()
    got = [tuple(r) for r in queries.op1_line_dedup(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and sum(r[4] for r in got) > 0


def test_keys_of_long_lines_are_wide(spark):
    """Long lines that share their first and last 25 characters only meet in no key, so none of them moves."""
    rng = random.Random(3)
    middle = lambda: "".join(rng.choice("abcdefgh ") for _ in range(150))
    lines = [(k, "the same beginning of all " + middle() + " and one end of them all") for k in range(40)]
    keys = line_dedup._keys(spark.createDataFrame(lines, "h long, line string"), line_dedup._limits(1, 16))
    assert keys.groupBy("key").agg(F.countDistinct("h").alias("lines")).where("lines > 1").count() == 0


@pytest.mark.parametrize("threshold", [None, 1, 3])
def test_links_across_classes(spark, threshold):
    """Lines about the lengths at which classes begin are linked as plain distances say."""
    rng = random.Random(11)
    limits = line_dedup._limits(threshold, 16)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(least + d)) for least, _ in limits if least < 110 for d in (-1, 0)]
    lines = sorted({edited(rng, b, n) for b in base for n in (0, 1, 2, 4)})
    t = lambda n: max((t for least, t in limits if n >= least), default=0)
    want = {(a, b) for b in range(len(lines)) for a in range(b) if (m := t(min(len(lines[a]), len(lines[b])))) and abs(len(lines[a]) - len(lines[b])) <= m and distance(lines[a], lines[b]) <= m}
    got = [(r.a, r.b) for r in line_dedup.line_links(spark.createDataFrame(list(enumerate(lines)), "h long, line string"), threshold, 16).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_written_leaves_no_shuffles(spark):
    from sluice.staging import CLEANUP, written

    every = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles
    files = lambda: {x for x in every().mkString("\n").split("\n") if "shuffle_" in x}
    old = files()
    out = written(spark.range(50_000).groupBy((F.col("id") % 5000).alias("k")).count())
    for _ in range(50):  # they go soon after the write
        if not (files() - old):
            break
        time.sleep(0.1)
    assert not files() - old and out.count() == 5000 and spark.conf.get(CLEANUP, None) is None
