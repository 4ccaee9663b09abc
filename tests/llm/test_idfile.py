import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from orderlens.llm import idfile, queries
from llm_cases import ODD

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def plain_pack(ids, block):
    """The words by definition: at each id the largest count that fits."""
    words, starts = [], []
    for b in range(0, len(ids), block):
        part, at = ids[b:b + block], 0
        starts.append(len(words))
        while at < len(part):
            if part[at] >> 60:
                words += [part[at] >> 60, 14 << 60 | part[at] & (1 << 60) - 1]
                at += 1
                continue
            for selector, n in [(15, 240), *((s, int(idfile.COUNTS[s])) for s in range(1, 15))]:
                own, width = part[at:at + n], 0 if selector == 15 else 60 // n
                if all(x < 1 << width for x in own):
                    words.append(selector << 60 | sum(x << width * k for k, x in enumerate(own)))
                    at += len(own)
                    break
    return words, starts


@pytest.mark.parametrize("top", [1, 2, 5, 300, 50257, 1 << 32, 1 << 60, 1 << 64])
@pytest.mark.parametrize("n", [0, 1, 59, 239, 241, 1000])
def test_words_by_definition_and_back(n, top):
    rnd = np.random.default_rng(n)
    ids = [int(x) % top for x in rnd.integers(0, 1 << 63, n)]
    if n == 1000:
        ids[100:500] = [0] * 400
        ids[600:700] = [top - 1] * 100
    for block in (1, 7, 256, 4096):
        words, starts = idfile.pack_ids(np.array(ids, np.uint64), block)
        assert (words.tolist(), starts.tolist()) == plain_pack(ids, block)
        assert idfile.unpack_ids(words, starts, n, block).tolist() == ids
        for a, b in ((0, n), (n // 3, n // 2), (n - n // 5, n), (n, n)):
            assert idfile.unpack_range(words, starts, n, a, b, block).tolist() == ids[a:b]


def hashed(text):
    """The engine's hash of a text; a null leaves the seed."""
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (h >> 63 << 64)


def expected(rows):
    whole, at, out = Tokenizer.from_file(BYTES), 0, []
    made = [(k, np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes(), hashed(t)) for k, t in rows]
    for key, data, _ in sorted(made, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        out.append((key, at, len(data) // 4, zlib.crc32(data)))
        at += len(data) // 4
    return out, at


def test_files_hold_odd_rows_in_order(spark, odd_docs, tmpdir_path):
    out = f"{tmpdir_path}/ids"
    idfile.write_documents(odd_docs, out, BYTES, 0)
    rows = idfile.read_ids(spark, out).collect()
    want, total = expected(ODD)
    assert [(r[0], r[1], r[2], zlib.crc32(r[3])) for r in sorted(rows, key=lambda r: r[1])] == want
    whole = b"".join(r[3] for r in sorted(rows, key=lambda r: r[1]))
    for a, b in ((0, total), (3, 40), (total - 1, total), (total, total + 9)):
        got = sorted(map(tuple, idfile.read_window(spark, out, a, b).collect()))
        assert b"".join(x[1] for x in got) == whole[4 * a:4 * b]


def test_segments_close_and_long_texts_stay_whole(spark, tmpdir_path):
    rows = [(k, f"word{k} " * (k * 37 % 90)) for k in range(300)] + [(1000, "long text " * 60000)]
    docs, out = spark.createDataFrame(rows, "doc_id long, text string"), f"{tmpdir_path}/ids"
    encoded = spark.createDataFrame([(k, np.array([1] * (k % 7) + [k], "<u4").tobytes()) for k in range(500)], "doc_id long, ids binary")
    idfile.write_ids(encoded.repartition(5), out, segment=64)
    assert spark.read.parquet(f"{out}/segments").count() > 10
    back = sorted(idfile.read_ids(spark, out).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in back] == list(range(500))
    assert [r["start"] for r in back] == np.cumsum([0] + [k % 7 + 1 for k in range(499)]).tolist()
    idfile.write_documents(docs, f"{out}-text", BYTES, 0)
    assert sorted(map(tuple, idfile.read_ids(spark, f"{out}-text").selectExpr("doc_id", "start", "n_tokens", "crc32(ids)").collect())) == expected(rows)[0]


def test_empty_table(spark, no_docs, tmpdir_path):
    idfile.write_documents(no_docs, f"{tmpdir_path}/ids", BYTES, 0)
    assert idfile.read_ids(spark, f"{tmpdir_path}/ids").count() == 0
    assert idfile.read_window(spark, f"{tmpdir_path}/ids", 0, 9).count() == 0


def test_query_equals_the_tokenizer(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op11_idfile(spark, sf).collect())) == expected(rows)[0]
