import random
from collections import Counter
from itertools import combinations

import numpy as np
import xxhash

from orderlens.llm import simhash
from llm_cases import ODD


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words, now = words + [now] * bool(now), ""
        else:
            now += c
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    part = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            a, b = part[i], part[j]
            part = [a if p == b else p for p in part]
    least = {}
    for p, (i, _) in zip(part, rows):
        if i is not None:
            least[p] = min(i, least.get(p, i))
    return Counter((i, f"{f:016x}", least.get(p)) for (i, _), f, p in zip(rows, fps, part))


def test_fingerprints_by_definition():
    for text in [t for _, t in ODD] + ["a b c d", "A  b\x0bC", "x " * 70_000 + "end of it"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text) if len(text or "") < 1000 else simhash.fingerprint(text)


def test_long_text_in_slices(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_SLICE", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_position_sets_cover_every_four():
    assert len(simhash.POSITION_SETS) == 20
    assert all(any(set(s) <= set(q) for s in simhash.POSITION_SETS) for q in combinations(range(8), 4))


def test_link_spans_exactly_the_linked_parts():
    rnd = random.Random(3)
    for _ in range(20):
        seeds = [rnd.getrandbits(64) for _ in range(4)]
        fps = {s ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for s in seeds for _ in range(30)}
        edges = list(simhash.link(np.array(sorted(fps), np.uint64)))
        part = {f: f for f in fps}
        for a, b in combinations(sorted(fps), 2):
            if (a ^ b).bit_count() <= 4 and part[a] != part[b]:
                old, new = max(part[a], part[b]), min(part[a], part[b])
                part = {f: new if p == old else p for f, p in part.items()}
        assert sorted(edges) == sorted((p, f) for f, p in part.items() if p != f)


def clustered(n, seed):
    """Texts in near-copy families: one word changed in a long text flips few bits."""
    rnd, out = random.Random(seed), []
    for family in range(n):
        words = [f"w{rnd.randrange(900)}" for _ in range(rnd.choice((60, 200)))]
        for _ in range(rnd.randint(1, 9)):
            w = list(words)
            w[rnd.randrange(len(w))] = f"v{rnd.randrange(50)}"
            out.append((len(out) + 1000, " ".join(w)))
    return out


def test_components_against_all_pairs(spark):
    rows = ODD + clustered(12, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (simhash.BLOCK, 2):  # 2: every shared posting is cut into blocks
        got = Counter(tuple(r) for r in simhash.components(df, block=block).collect())
        assert got == plain_components(rows)


def test_random_fingerprints_lose_no_link(spark):
    rnd = random.Random(5)
    seeds = [rnd.getrandbits(64) for _ in range(30)]
    fps = sorted({s ^ sum(1 << b for b in rnd.sample(range(64), k)) for s in seeds for k in (0, 1, 2, 3, 4, 4, 5, 7)})
    rows = [(i, simhash.signed(f)) for i, f in enumerate(fps)]
    part = list(range(len(fps)))
    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4 and part[i] != part[j]:
            low, high = sorted((part[i], part[j]))
            part = [low if p == high else p for p in part]
    got = simhash.resolve(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    assert {r.fp: r.component_id for r in got} == {f: p for (_, f), p in zip(rows, part)}


def test_long_chain_becomes_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    got = simhash.connected(edges).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(1, 61)}


def test_odd_rows_clashing_columns_and_empty_table(odd_docs, no_docs):
    assert Counter(tuple(r) for r in simhash.components(odd_docs).collect()) == plain_components(ODD)
    assert simhash.components(no_docs).collect() == []


def parts(links, nodes):
    root = {n: n for n in nodes}
    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        root[find(b)] = find(a)
    return {n: min(m for m in nodes if find(m) == find(n)) for n in nodes}


def test_long_postings_are_probed_and_lose_no_link():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
    close = [int(x) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for x in base for _ in range(3)]
    fps = np.unique(np.array([*base.tolist(), *close], np.uint64) & np.uint64(0xFFFFFFFFFF) | np.uint64(7 << 40))  # three shared bytes
    assert len(fps) > simhash.PROBED
    nodes = fps.tolist()
    all_links = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1:] if bin(a ^ b).count("1") <= 4]
    assert parts(simhash.link(fps), nodes) == parts(all_links, nodes) and len(all_links) > 100


def test_a_full_block_of_strangers_takes_moments():
    import time
    fps = np.random.default_rng(9).integers(0, 1 << 40, simhash.BLOCK, dtype=np.uint64)
    start = time.process_time()
    assert sum(1 for _ in simhash.link(fps)) < len(fps)
    assert time.process_time() - start < 60
