import json
import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderlens.llm import bpe, packing
from llm_cases import ODD

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = [
    "Hello  world", "a   b", " lead", "tail ", "tail  ", "x\n y", "x \ny", "x \n \n y", "a\t b", "a  b", "it's we'll 'S",
    "<|endoftext|>", "a<|startoftext|> b<|endoftext|>c", "é ́ ΣΑΣ İ", "漢字かな交じり文", "😀😀 a", "123 4567", "", " ", "   ",
    "\x1c x \x85 y", "A" * 50, "-" * 40, "the " * 30, "\r\n\r\n a", "foo　 　bar",
]


whole = lru_cache(Tokenizer.from_file)


def plain(path, text):
    return whole(path).encode(text or "", add_special_tokens=False).ids


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoding_equals_the_tokenizer(path):
    own = bpe.Encoder(path)
    for text in TEXTS + [" ".join(TEXTS), "\n".join(TEXTS)]:
        assert ids_of(own.encode(text)) == plain(path, text), text


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("leaf", [1, 2, 7, 64])
def test_tree_concatenation_equals_the_tokenizer(path, leaf):
    rnd, own = random.Random(leaf), bpe.Encoder(path, leaf)
    for alphabet in ("ab", "aaab", "theinrstcomp", "éßñ漢a", "-=*", "0123", "a1-é<|endoftext|>"):
        for n in (3, 50, 400):
            text = "".join(rnd.choice(alphabet) for _ in range(n))
            assert ids_of(own.encode(text)) == plain(path, text), text
            mixed = f"{text} {text[:9]}  {text}"
            assert ids_of(own.encode(mixed)) == plain(path, mixed)
    marked = "abc" * 40 + "<|endoftext|>" + "thein" * 30
    assert ids_of(own.encode(marked)) == plain(path, marked)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_slices_and_cleared_cache(path, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 16)
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 3)
    own = bpe.Encoder(path)
    for text in TEXTS + [" ".join(TEXTS), "x" * 100, "one two  three   four    five " * 9]:
        assert ids_of(own.encode(text)) == plain(path, text), text


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_documents_there_and_back(spark, odd_docs, no_docs, path):
    rows = bpe.decode(bpe.encode(odd_docs, path), path).collect()
    want = sorted((str(i), plain(path, t), whole(path).decode(plain(path, t), skip_special_tokens=False)) for i, t in ODD)
    assert sorted((str(r.doc_id), ids_of(r.ids), r.decoded) for r in rows) == want
    assert all(r.n_tokens == len(ids_of(r.ids)) for r in rows)
    assert bpe.encode(no_docs, path).collect() == []


def test_model_file_has_the_suffix_the_tree_relies_on():
    with open(WORDS, encoding="utf-8") as f:
        assert json.load(f)["model"]["end_of_word_suffix"] == "</w>"


def test_cuts_are_binary():
    for n in [*range(1, 70), 2047, 2048, 2049, 6143, 10_000]:
        got = packing.cuts(n, 32 if n < 70 else 2048)
        assert [a for a, _ in got] == [sum(x for _, x in got[:i]) for i in range(len(got))]
        assert sum(x for _, x in got) == n and all(x & (x - 1) == 0 for _, x in got)
        small = [x for _, x in got if x < (32 if n < 70 else 2048)]
        assert small == sorted(set(small), reverse=True)


def test_every_id_in_one_piece(spark, odd_docs, no_docs):
    long = spark.createDataFrame([(50, "word salad " * 3000)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(long)
    rows = packing.pack(docs, BYTES, 1).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    assert all(len(r.ids) == 4 * r.length and r.length & (r.length - 1) == 0 and r.length <= 2048 for r in rows)
    texts = {50: "word salad " * 3000, 1: ODD[0][1], 2: None, 3: "", 5: "one two", 7: ODD[8][1]}
    for key, text in texts.items():
        own = sorted((r.start, bytes(r.ids), r.doc_tokens) for r in rows if r.doc_id == key)
        ids = [*plain(BYTES, text), 1]
        assert ids_of(b"".join(x for _, x, _ in own)) == ids and {n for *_, n in own} == {len(ids)}
    assert sum(r.doc_id == 6 and r.start == 0 for r in rows) == 2  # repeated rows stay two
    assert packing.pack(no_docs, BYTES, 1).collect() == []


def test_query_digest(spark, tmp_path):
    from orderlens.llm import queries

    spark.createDataFrame([(0, "a b c"), (1, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {(r.doc_id, r.start): r for r in queries.op6_packing(spark, str(tmp_path)).collect()}
    ids = np.array([*plain(BYTES, "a b c"), 1], "<u4")
    assert rows[0, 0].ids_crc32 == zlib.crc32(ids.tobytes()) and rows[0, 0].length == 4
    assert rows[1, 0].doc_tokens == 1


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("leaf", [24, 31, 50])
def test_halves_joined_anywhere_equal_the_tokenizer(path, leaf):
    """Cuts fall inside words, white space, added tokens and composed characters."""
    rnd, own = random.Random(leaf), bpe.Encoder(path, leaf)
    pieces = [t for t in TEXTS + ["plain words", "e\u0301te\u0301", "I'll they're"] if max(map(len, t.split()), default=0) < 20]
    for _ in range(60):
        text = " ".join(rnd.choice(pieces) for _ in range(rnd.randint(8, 40)))
        assert ids_of(own.encode(text)) == plain(path, text), text
    assert own.joins > 100


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_documents_of_the_given_table_are_joined(spark, path):
    """The tree is entered on the given texts, at the leaf that the queries use."""
    own = bpe.Encoder(path)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert ids_of(own.encode(text)) == plain(path, text)
    assert own.joins >= sum(len(t or "") > own.leaf for t in texts) > 0


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_very_long_texts(path):
    rnd, own = random.Random(4), bpe.Encoder(path)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 9))) for _ in range(500)]
    text = " ".join(rnd.choice(words) for _ in range(200_000))
    assert ids_of(own.encode(text)) == plain(path, text) and own.joins > 100
    assert ids_of(own.encode("x" * 300_000 + " end")) == plain(path, "x" * 300_000 + " end")
