import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from sluice.llm import packing, token_files, tokens
from sluice.llm._jobs import scratch
from test_text_operators import ODD, SCHEMA, made, rows_of

TRICKY = ["a  b\n\n c \nx's it's  ", "\n", "a\tb c", "<|endoftext|> hi", "é ́x Σ ΑΣ.", "'S'll", " lead", "tail \n", "日本 語　x", "a\x1cb !\x1c!", "İ ǅ ß", "3.5, 5,010.", "x..y, (a.) b_. c", "Mr. Smith, Jr.\nEnd.", "word,\nword.", ".", "a . b, c", "w. , x", "one.\n(two).\nthree, four."]
TEXTS = ODD + TRICKY + made(30, 9) + ["long text here, with stops. " * 3000]


def ids_of(name):
    lib = Tokenizer.from_file(public_tokenizers.path(name))
    lib.encode_special_tokens = True
    return lambda t: [*lib.encode(t or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("most", [500_000, 40])
def test_encoder(name, most, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_KEPT", most)
    tokens._encoders.clear()
    encode, plain = tokens.encoder(public_tokenizers.path(name), 1), ids_of(name)
    for part in (TEXTS, TEXTS, TEXTS[:9], TEXTS[9:], []):
        ids, bounds = encode([t or "" for t in part])
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain(t) for t in part]
    tokens._encoders.clear()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_on_random_texts(name):
    """No difference from the plain library call on texts of stops, marks, odd spaces and special strings."""
    parts = ["a", " ", ".", ",", " .", ".,", "\n", "\n\n", "  ", "word", "Don't", "'s", "İ", "ı", "é", "e\u0301", "\u0301", "\r", "\t", "\u00a0", "\u3000", "3", "12345", "<|endoftext|>", "</w>", "Ġ", "Ċ", "#", "!!", "-", "中文", "🙂", "\u200d", "ﬁ", "Σ", "\x00", "\x1c", "\x85", "\u2028", "x.y", "3.14", "1,000", "...", "(a)", "\ufeff", "_", "a_b", "Ё."]
    rng = random.Random(3)
    texts = ["", "\r", "\r\r", "İ.", "İ,", "a ., b", "w 3 .,", " .", "a .\n.b", *("".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(20_000))]
    tokens._encoders.clear()
    ids, bounds = tokens.encoder(public_tokenizers.path(name), 1)(texts)
    lib = Tokenizer.from_file(public_tokenizers.path(name))
    lib.encode_special_tokens = True
    want = lib.encode_batch(texts, add_special_tokens=False)
    assert [t for t, a, b, w in zip(texts, bounds, bounds[1:], want) if ids[a:b].tolist() != [*w.ids, 1]] == []
    tokens._encoders.clear()


def test_token_files(spark):
    df = spark.createDataFrame(rows_of(TEXTS)[::-1] + [(3, "again", "s", 1, "k"), (None, "none", "s", 1, "k")], SCHEMA)
    path = scratch(spark)
    token_files.write_tokens(df, public_tokenizers.path("word_bpe_49k.json"), path, page_rows=10)
    got = sorted(token_files.checksums(token_files.read_tokens(spark, path)).collect(), key=lambda r: r.start)
    plain, at = ids_of("word_bpe_49k.json"), 0
    want = sorted([(i, t) for i, t, *_ in rows_of(TEXTS)] + [(3, "again")], key=lambda r: r[0])
    assert [r.doc_id for r in got] == [None, *(i for i, _ in want)]
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted((len(x), crc(x)) for x in [plain("none"), *(plain(t) for _, t in want)])
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert token_files.read_tokens(spark, path, "doc_id", "n_tokens").columns == ["doc_id", "n_tokens"]
    local = path.removeprefix("file:")
    import pathlib

    meta = pq.ParquetFile(next(p for p in pathlib.Path(local).glob("*.parquet") if pq.ParquetFile(p).metadata.num_rows > 5)).metadata.row_group(0)
    by = {meta.column(k).path_in_schema: meta.column(k) for k in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in by["doc_id"].encodings and "RLE_DICTIONARY" in by["tokens.list.element"].encodings
    assert by["doc_id"].has_offset_index and by["doc_id"].has_column_index
    token_files.write_tokens(df.limit(0), public_tokenizers.path("word_bpe_49k.json"), empty := scratch(spark))
    assert token_files.checksums(token_files.read_tokens(spark, empty)).count() == 0


def test_packing(spark):
    df = spark.createDataFrame(rows_of(TEXTS) + [(3, "again", "s", 1, "k"), (None, None, "s", 1, "k")], SCHEMA)
    got = packing.pack(df, public_tokenizers.path("byte_bpe_50k.json"), group=64).collect()
    plain = ids_of("byte_bpe_50k.json")
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    docs = defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
    for i, t, *_ in rows_of(TEXTS):
        if i != 3:
            ids, at = plain(t), 0
            for r in sorted(docs[i], key=lambda r: r.start):
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at : at + r.length]))
                at += r.length
            assert at == len(ids)
    assert sum(r.length for r in docs[3]) == len(plain(TEXTS[3])) + len(plain("again")) and len(docs[None]) == 1
    assert packing.pack(df.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_windows_are_full():
    sizes = np.random.default_rng(1).integers(1, 513, 2000)
    of = packing.windows(sizes, 2048)
    loads = np.bincount(of, weights=sizes)
    assert loads.max() <= 2048 and 1 - sizes.sum() / (2048 * len(loads)) < 0.01
    assert packing.windows(np.array([2048, 2048, 1]), 2048).max() == 2
