import math
import random

import pytest

from orderlens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank string"


def plain(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    best = {}
    for q, x in ok:
        if q % every == 0:
            best.setdefault(q, {})[tuple(x)] = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q]
    return {(q, n + 1, i, -s) for q, kinds in best.items() for n, (s, i) in enumerate(sorted(next(iter(kinds.values())))[:k])}


def vectors(n, dims, seed):
    rnd = random.Random(seed)
    return [(i, [float(rnd.choice([rnd.gauss(0, 1), 0, 0.5])) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 3, 33])
def test_against_all_pairs(spark, dims):
    rows = vectors(260, dims, dims)
    rows += [(300 + i, rows[7][1]) for i in range(20)]  # ties
    rows += [(400, None), (401, [None] * dims), (402, [float("nan")] * dims), (403, [float("inf")] * dims), (None, rows[1][1]), (450, []), (451, [1.0])]
    rows += [rows[60], rows[100], rows[60]]  # repeated rows
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    import struct
    single = [(i, None if v is None else [x if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rows]
    for block, queries in ((8192, 2048), (16, 2)):
        got = topk.top_k(df, block=block, queries=queries).collect()
        ids = [(r.query_id, r["rank"], r.vec_id, r.score) for r in got]
        assert len(ids) == len(set(ids)) and set(ids) == plain(single)


def test_large_components_stay_exact(spark):
    rows = [(0, [3e5, -3e5, 1.0]), (1, [3e5, 3e5, 0.0]), (2, [3e5, 3e5, 1.0]), (3, [-3e5, 3e5, 0.5])]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df).collect()}
    assert got == plain(rows)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).collect() == []
    assert topk.top_k(spark.createDataFrame([(50, [1.0])], schema)).collect() == []
    assert [tuple(r) for r in topk.top_k(spark.createDataFrame([(50, [1.0]), (3, [2.0])], schema)).collect()] == [(50, 1, 3, 131072)]


def test_terms_are_split_by_bounds_and_threshold():
    """On vectors with a few strong terms most are not essential, and a threshold from elsewhere passes
    blocks over; the results are those of the whole product."""
    import numpy as np
    rng = np.random.default_rng(3)
    weights = np.concatenate([np.full(4, 40.0), np.full(60, 1.0)])
    block = np.floor(rng.normal(size=(2000, 64)) * weights)
    ids, low, high = np.arange(2000), block.min(axis=0), block.max(axis=0)
    work, carried = topk.Work(), topk.Work()
    for q in range(0, 2000, 50):
        scores = block @ block[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:5]
        want = [(int(scores[i]), int(i)) for i in order]
        assert topk.best(block[q], ids, q, block, low, high, 5, work=work) == want
        assert topk.best(block[q], ids, q, block, low, high, 5, floor=want[-1][0], work=carried) == want
        assert topk.best(block[q], ids, q, block, low, high, 5, floor=want[1][0]) == [w for w in want if w[0] >= want[1][0]]
        assert topk.best(block[q], ids, q, block, low, high, 5, floor=1e12, work=carried) == []
    assert work.essential < 0.5 * work.terms and carried.essential <= work.essential and carried.passed == 40
    assert carried.read <= work.read < 0.4 * work.components


def test_thresholds_are_carried_between_blocks(spark):
    rows = vectors(700, 8, 5)
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    import struct
    single = [(i, [struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rows]
    got = topk.top_k(df, block=64, queries=3).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == plain(single)
