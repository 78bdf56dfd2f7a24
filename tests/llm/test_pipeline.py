"""The pipeline, stage by stage on its own input, against plain versions."""

import random

import brute
import corpus_pipeline
import public_tokenizers
from test_native import copied, plain_classes
from tokenizers import Tokenizer

from sluice.llm import line_dedup
from sluice.llm._jobs import written


def documents():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "te", "su"]) for _ in range(rng.randrange(1, 5)))
    line = lambda n: " ".join(word() for _ in range(n))
    items = [line(20) for _ in range(5)]
    shared = line(60)
    texts = ["\n".join(line(rng.randrange(5, 30)) for _ in range(rng.randrange(1, 5))) for _ in range(150)]
    for k in range(0, 40, 2):
        texts[k] += "\n" + shared
    texts[41] += " " + items[0]
    texts += [texts[60], texts[61] + " more", None, ""]
    one = texts[62].split()
    one[len(one) // 2] = "changed"
    texts.append(" ".join(one))
    bad = set(range(100, 130))
    for k in bad:
        texts[k] += " idiot moron stupid"
    return texts, items, bad


def test_stages(spark, tmp_path):
    texts, items, bad = documents()
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, h string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in bad)) for i in range(140)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names, columns = [], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = written(stage(spark, docs, d))
        rows = docs.collect()
        names.append(name)
        if name != "packing":
            assert docs.columns == columns
            after = {r.doc_id: r.text for r in rows}
        if name == "toxicity":
            assert set(before) - set(after) == bad
        elif name == "line_dedup":
            gone = {(i, k) for i, k, *_, kept in plain_classes(sorted(before.items()), line_dedup.THRESHOLD, line_dedup.MIN_CHARS, line_dedup.FUZZY_CHARS) if not kept}
            want = {}
            for i, t in before.items():
                left = t if not any((i, k) in gone for k in range(9)) else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
                if left is t or not copied(t, left, line_dedup.MIN_CHARS):
                    want[i] = left
            assert after == want and sum("\n" in t or len(t) > 100 for t in after.values() if t) > 50
            assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
        elif name == "near_duplicates":
            assert set(after) == {i for i, (_, c) in brute.near_duplicates(sorted(before.items())).items() if c == i}
        elif name == "decontamination":
            assert set(before) - set(after) == {r[0] for r in brute.contamination(sorted(before.items()), list(enumerate(items))) if r[5]}
        else:
            lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            assert sum(r.length for r in rows) == sum(len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for t in before.values())
    assert names == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    assert corpus_pipeline.run(spark, d).count() == len(rows)
