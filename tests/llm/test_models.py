import random
import zlib

import numpy as np
import pytest

from sluice.llm import _linear, language_id, toxicity

STEMS = {"aa": ["kor", "tal", "mi", "sen"], "bb": ["zhu", "gri", "vop", "ek"], "cc": ["lée", "oué", "an", "ille"]}


def words(rng, lang, n):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        lang = rng.choice(sorted(STEMS))
        text, bad = words(rng, lang, rng.randrange(5, 80)), rng.random() < 0.2
        if bad:
            text += " " + " ".join(rng.choice(["idiot", "stupid", "grumpfel" + rng.choice("abcdef")]) for _ in range(2))
        rows.append((i, text, None if i % 11 == 0 else lang, "s", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels


SCHEMA = "doc_id long, text string, lang string, source string, score int"


def test_language(spark, corpus):
    rows, _ = corpus
    odd = [(2000, None, "aa", "s", 1), (2001, "123 !", "bb", "s", 1), (None, rows[1][1], "aa", "s", 1), (2002, "", None, "s", 1)]
    got = language_id.identify(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + len(odd) and {by[k].lang_pred for k in (2000, 2001, 2002)} == {"und"} and by[2000].score == 0
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    held = [(by[i].lang_pred, lang) for i, _, lang, *_ in rows if lang and by[i].held_out]
    assert len(held) > 200 and np.mean([a == b for a, b in held]) > 0.97
    none = language_id.identify(spark.createDataFrame([(1, "abc", None, "s", 1)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert language_id.identify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_toxicity(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame([*rows, (3000, None, "aa", "s", 1), (3001, "", "aa", "s", 1), (None, rows[0][1], "aa", "s", 1)], SCHEMA)
    given = spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, given).collect()
    by = {r.doc_id: r for r in got}
    true = {i: t for i, _, t in labels}
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [i for i in true if by[i].held_out]
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in true)
    caught, wrong = [by[i].predicted for i in held if true[i]], [by[i].predicted for i in held if not true[i]]
    assert np.mean(caught) > 0.85 and np.mean(wrong) < 0.03
    left = toxicity.drop_toxic(docs, given)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in got if not r.predicted)
    flat = toxicity.toxicity(docs, given.limit(0)).select("score").distinct().count()
    assert flat == 1 and toxicity.toxicity(docs.limit(0), given).count() == 0


def test_repeated_ids_give_one_model(spark, corpus):
    rows, labels = corpus
    twice = [*rows[:300], *((i, f"{t} once more", "bb" if lang else lang, *rest) for i, t, lang, *rest in rows[:300])]
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = []
    for parts, order in ((1, twice), (5, twice[::-1])):
        docs = spark.createDataFrame(order, SCHEMA).repartition(parts)
        at, weight, bias = toxicity.trained(docs, given, sample=100).value
        langs = sorted((r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs, sample=100).collect())
        got.append((at.tolist(), weight.tolist(), bias, langs))
    assert got[0] == got[1]


def test_label_model():
    rng = np.random.default_rng(1)
    y = rng.random(2000) < 0.2
    votes = np.stack([np.where(y, rng.random(2000) < 0.7, rng.random(2000) < 0.02) for _ in range(5)] + [rng.random(2000) < 0.3], axis=1)
    votes = np.concatenate([votes, votes[:, :1], votes[:, :1]], axis=1)  # two copies of a voter
    gold = np.where(rng.random(2000) < 0.05, ~y, y).astype(int)
    post, model = toxicity.label_model(votes.astype(np.uint8), gold)
    assert ((post > 0.5) == y).mean() > 0.97 and model["weight"][0] < 0.6 < model["weight"][1]


def test_temperature():
    rng = np.random.default_rng(2)
    z = rng.normal(size=(4000, 3))
    label = np.array([rng.choice(3, p=p) for p in _linear.softmax(z)])
    assert abs(_linear.temperature(z * 5, label) - 5) < 0.5
