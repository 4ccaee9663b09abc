import hashlib
import random
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orderlens.llm import align, queries
from llm_cases import ODD

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = ["Hello  world", "a<|endoftext|>b", "</s><s> x", "漢字かな交じり文 😀😀", "tab\tand\r\nline  ends \n", "naïve ﬁ ½ ㍿ é", "x▁y", "▁", "=" * 70 + "-" * 33,
         "\x00\x01", "　wide　space ", "ab" * 300, "1234567890 " * 20, "​zero­width", "a" * 1000]


@lru_cache
def tokenizer_a():
    return Tokenizer.from_file(A)


@lru_cache
def pieces_b():
    return sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(text):
    """Ids and bytes of both, by each library's own vocabulary."""
    a, b = tokenizer_a(), pieces_b()
    a.encode_special_tokens = True
    plain = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c]
    back = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in plain)}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
    ids_b = b.encode(text) if text else []
    data_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
    data_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    whole = (" " + (text or "")).encode()
    if b"".join(data_a) != whole or b"".join(data_b) != whole:
        return [], [], [], []
    return ids_a, ids_b, data_a, data_b


def plain_groups(text):
    ids_a, ids_b, data_a, data_b = plain_tokens(text)
    ends = lambda data: np.cumsum([len(x) for x in data]).tolist()
    ends_a, ends_b = ends(data_a), ends(data_b)
    groups, at_a, at_b = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        to_a, to_b = ends_a.index(cut) + 1, ends_b.index(cut) + 1
        groups.append((ids_a[at_a:to_a], ids_b[at_b:to_b]))
        at_a, at_b = to_a, to_b
    return groups


def expected(rows):
    per = [(key, plain_groups(text)) for key, text in rows]
    links = [[(a, b) for left, right in groups for a in left for b in right] for _, groups in per]
    held = Counter(p for own in links for p in set(own))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (key, groups), own in zip(per, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(own),
                    sum(held[p] == best[p[0]] for p in own), sum(held[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_groups_by_shared_ends():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randrange(1, 40)
        ends = [sorted({*rnd.sample(range(1, n + 1), rnd.randrange(n)), n}) for _ in range(2)]
        got = align.groups_of(*(np.array(e) for e in ends))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        for own, found in zip(ends, got):
            assert found.tolist() == [sum(c < e for c in cuts) for e in own]


@pytest.mark.parametrize("head", [0, 1, 7, 1 << 18])
def test_links_by_definition(spark, odd_docs, head):
    rows = [(100 + k, t) for k, t in enumerate(TEXTS)] + [(200, TEXTS[0]), (200, TEXTS[0]), (None, "Hello world")]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(align.link_report(docs, A, B, head)) == expected(ODD + rows)


def test_small_bounds_change_nothing(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    own = align.vocabularies(A, B)
    docs = [own.encode(t) for t in TEXTS]
    want = [(*x[:5], x[5].tolist(), x[6].tolist()) for x in align.align_batch(own, docs)]
    assert [x[4].decode() for x in want] == [";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain_groups(t)) for _, t in rows]
    monkeypatch.setattr(align, "SMALL", 0)
    monkeypatch.setattr(align, "GATHERED", 2)
    assert [(*x[:5], x[5].tolist(), x[6].tolist()) for x in align.align_batch(own, docs)] == want


def test_clashing_columns_and_empty_tables(spark, odd_docs, no_docs):
    assert rows_of(align.link_report(odd_docs, A, B)) == expected(ODD)
    assert rows_of(align.link_report(no_docs, A, B)) == []
    groups = {r["doc_id"]: r["groups"] for r in align.align(odd_docs, A, B).collect()}
    assert groups[3] == "" and groups[5].count(";") >= 1


def test_query_by_definition(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(queries.op13_align(spark, sf)) == expected(rows)
