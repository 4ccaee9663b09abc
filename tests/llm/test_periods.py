import hashlib
import random
import re
import zlib

import pytest

from orderlens.llm import periods, queries
from llm_cases import ODD


def plain_runs(words, least=6, exponent=4):
    """By definition: stretches that keep a period, cannot be longer, and have no smaller one."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            a, b = i, j + q
            if j > i and b - a >= max(least, exponent * q) and not any(
                    all(words[k] == words[k + d] for k in range(a, b - d)) for d in range(1, q)):
                out.append((a, b - a, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def made(rnd):
    kinds, size = rnd.choice((1, 2, 2, 3, 5)), rnd.randrange(70)
    words = [b"%d" % rnd.randrange(kinds) for _ in range(size)]
    if rnd.random() < 0.6:
        words = []
        while len(words) < size:
            words += [b"%d" % rnd.randrange(kinds + 3) for _ in range(rnd.randrange(1, 7))] * rnd.randrange(1, 9)
            if rnd.random() < 0.3:
                words.pop()
    return words * rnd.choice((1, 1, 1, 2, 5))


def test_runs_by_definition():
    rnd = random.Random(5)
    found = 0
    for _ in range(4000):
        words = made(rnd)
        want = plain_runs(words)
        found += len(want)
        assert periods.runs_of(words) == want, words
        assert periods.collapsed(words, want) == plain_collapsed(words, want)
    assert found > 3000


@pytest.mark.parametrize("least,exponent", [(6, 4), (3, 4), (12, 4), (6, 5), (20, 7)])
def test_other_bounds(least, exponent):
    rnd = random.Random(least)
    for _ in range(800):
        words = made(rnd)
        assert periods.runs_of(words, least, exponent) == plain_runs(words, least, exponent), words


def test_grammar_derives_the_text():
    rnd = random.Random(3)
    for _ in range(500):
        ids = [rnd.randrange(rnd.choice((1, 2, 4, 30))) for _ in range(rnd.randrange(2, 80))]
        rules, sizes, places, base = periods.grammar(ids)
        text = {i: [i] for i in range(base)}
        for k, (a, b) in enumerate(rules):
            text[base + k] = text[a] + text[b]
            assert sizes[base + k] == len(text[base + k])
            assert ids[places[k]:places[k] + sizes[base + k]] == text[base + k]
        assert text[base + len(rules) - 1] == ids


def test_repeats_shrink_the_grammar():
    assert len(periods.grammar([1, 2, 3, 4, 5] * 400)[0]) < 40


@pytest.mark.parametrize("words", [[b"a"] * 300000, [b"a", b"b", b"c"] * 100000, [b"%d" % k for k in range(30000)] * 10,
                                   [b"%d" % (k * k % 7 % 3) for k in range(200000)]])
def test_very_long_texts_take_about_linear_time(words):
    runs = periods.runs_of(words)
    assert runs and max(n for _, n, _ in runs) > 0.9 * len(words)


def test_odd_rows(spark, odd_docs, no_docs):
    got = sorted(map(str, ((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periods.find_runs(odd_docs).collect())))
    want = []
    for key, text in ODD:
        words = [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
        want.append(str((key, len(words), [], " ".join(words))))
    assert got == sorted(want)
    assert periods.find_runs(no_docs).count() == 0
    with pytest.raises(ValueError):
        periods.find_runs(odd_docs, least_exponent=3)


def expected(key, text):
    words = [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(key).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    words = [w.encode() for w in words]
    runs = plain_runs(words)
    best = (None, None, None, None)
    if runs:
        from fractions import Fraction
        s, m, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, m, q, 1000 * m // q)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return key, len(runs), *best, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), sha(plain_collapsed(words, runs))


def test_query_by_definition(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 9000 or text is null")
    found = {r["doc_id"]: tuple(r) for r in queries.op12_periods(spark, sf).collect()}
    small = docs.collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count() and len(small) > 100
    for r in small:
        assert found[r["doc_id"]] == expected(r["doc_id"], r["text"])
    assert sum(f[1] > 0 for f in found.values()) > 5
