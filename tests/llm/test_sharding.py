import random
import zlib
from collections import Counter, defaultdict

from llm_cases import ODD

from orderlens.llm import sharding


def plain_best_fit(items, capacity):
    rooms, out = [], [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][1])):
        fits = [(r, b) for b, r in enumerate(rooms) if r >= items[i][0]]
        if fits:
            r, b = min(fits)
        else:
            b = len(rooms)
            rooms.append(max(capacity, items[i][0]))
        rooms[b] -= items[i][0]
        out[i] = b
    return out


def height(n):
    if n is None:
        return 0
    a, b = height(n.left), height(n.right)
    assert abs(a - b) <= 1
    return 1 + max(a, b)


def test_best_fit_through_the_tree_equals_a_plain_search():
    rnd = random.Random(1)
    for _ in range(60):
        items = [(rnd.randint(0, 60), i) for i in range(rnd.randint(0, 80))]
        capacity = rnd.randint(1, 120)
        assert sharding.best_fit_decreasing(items, capacity) == plain_best_fit(items, capacity)


def test_tree_stays_balanced():
    rnd, tree, inside = random.Random(2), sharding.Bins(), []
    for i in range(600):
        if inside and rnd.random() < 0.4:
            need = rnd.randint(0, 100)
            fits = [k for k in inside if k[0] >= need]
            got = tree.take(need)
            assert got == (min(fits) if fits else None)
            inside = [k for k in inside if k != got]
        else:
            inside.append((rnd.randint(0, 100), i))
            tree.add(inside[-1])
        height(tree.root)


def test_capacity_is_the_smallest_that_is_enough():
    items = [(s, i) for i, s in enumerate([50, 40, 30, 30, 20, 10, 10, 5, 5])]
    got = sharding.pack_into(items, 4)
    loads = Counter()
    for (s, _), b in zip(items, got):
        loads[b] += s
    assert max(loads.values()) == 50 and set(loads) == {0, 1, 2, 3}
    assert sharding.pack_into([], 8) == [] and sharding.pack_into([(7, 0)], 8) == [0]


def check(rows, given, shards=8):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in given)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sizes_near_equal_and_groups_whole(spark):
    rnd = random.Random(4)
    given = [(i, "x" * rnd.randint(0, 400) + str(i)) for i in range(3000)]
    given += [(10_000 + i, f"copy {i % 7}" * 20) for i in range(300)] + [(20_000, "big" * 9000)]
    rows = sharding.shard(spark.createDataFrame(given, "doc_id long, text string"), rows_a_range=50).collect()
    check(rows, given)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) <= 0.01 * sum(loads.values()) / 8
    text, where = dict(given), defaultdict(set)
    for r in rows:
        where[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_a_group_above_its_share_stays_whole(spark):
    given = [(i, "the same text") for i in range(500)] + [(1000 + i, f"text {i}") for i in range(500)] + [(i, None) for i in range(9)]
    rows = sharding.shard(spark.createDataFrame(given, "doc_id long, text string"), rows_a_range=10).collect()
    check(rows, given)
    hot = {r.shard for r in rows if r.size == 14}
    assert len(hot) == 1 and len({r.shard for r in rows}) == 8


def test_odd_rows_and_empty_table(odd_docs, no_docs):
    check(sharding.shard(odd_docs).collect(), ODD)
    assert sharding.shard(no_docs).collect() == []
