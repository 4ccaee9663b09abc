"""SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Two fingerprints at most four bits apart differ in at most four
bytes, so they share at least four of eight (position, byte) entries: the guaranteed minimum. A
plain index of 8 x 256 postings would hold N / 256 entries each and pair them all, so the index is
keyed on *sets* of three positions. ``POSITION_SETS`` is a Turan system: every four of the eight
positions contain one of its twenty sets, so every pair that reaches the minimum meets in at least
one posting. Inside a posting the shared positional bytes of a pair are tallied, pairs below the
minimum go, and the rest are verified on the exact bit distance. A posting yields at most a
spanning forest of its links, never all pairs; a posting longer than ``block`` is cut into blocks
whose block pairs are separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import batched, map_rows, ship, stage
from orderlens.session import drop_stage

SHINGLE_WORDS, SEED, MAX_BITS = 4, 42, 4
#: Positions in three classes; a set lies in one class, or has two in a class and one in the next.
_CLASSES = (0, 0, 0, 1, 1, 1, 2, 2)
POSITION_SETS = [
    s for s in combinations(range(8), 3)
    if len({_CLASSES[p] for p in s}) == 1
    or any(sorted(_CLASSES[p] for p in s) == sorted((c, c, (c + 1) % 3)) for c in range(3))
]
#: Fingerprints of one posting that a task links at once (16 bytes each).
BLOCK = 1 << 16
#: Postings up to this size are compared without probing further positions.
PROBED = 64
_SLICE = 1 << 16


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash; 0 where the text is null or has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    spans = zip([0, *(e + 1 for e in ends)], ends[width - 1:]) if len(words) >= width else [(0, len(joined))]
    n = max(1, len(words) - width + 1)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for _ in range(0, n, _SLICE):
        some = np.fromiter((digest(joined[a:b], SEED) for _, (a, b) in zip(range(min(n, _SLICE)), spans)), np.uint64)
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``fp`` (the fingerprint's bits as a signed long)."""
    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for key, text in items:
            fp = fingerprint(text)
            yield (key, signed(fp)), 16

    typed = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    return map_rows(docs, typed, run, pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())]))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of ``a`` lie within ``max_bits`` of one of ``b``: tally, count filter, verification."""
    x = np.ascontiguousarray(a)[:, None] ^ b[None, :]
    shared = (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=-1)
    i, j = np.nonzero(shared >= 8 - max_bits)
    near = np.zeros(len(a), bool)
    near[i[np.bitwise_count(x[i, j]) <= max_bits]] = True
    return near


def link(fps: np.ndarray, max_bits: int = MAX_BITS) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among one posting's fingerprints (uint64), as (smallest of its part,
    other).

    All share the bytes of the posting's positions. Where those are fewer than the guaranteed minimum, a
    pair that reaches it shares one more, so the posting is probed at each other position: only
    fingerprints with an equal byte there are compared, a 256th of them in the mean."""
    left = np.unique(fps)
    if len(left) > PROBED:
        held = left.view(np.uint8).reshape(-1, 8)
        other = [p for p in range(8) if (held[:, p] != held[0, p]).any()]
        if len(other) > max_bits:
            over: dict[int, int] = {}  # towards the smallest of a part

            def top(f: int) -> int:
                while (up := over.get(f, f)) != f:
                    over[f] = f = over.get(up, up)
                return f

            for p in other:
                order = np.argsort(held[:, p], kind="stable")
                for same in np.split(left[order], np.flatnonzero(np.diff(held[order, p])) + 1):
                    for a, b in forest(same, max_bits):
                        a, b = sorted((top(a), top(b)))
                        over[b] = a
            for f in list(over):
                if (root := top(f)) != f:
                    yield root, f
            return
    yield from forest(left, max_bits)


def forest(left: np.ndarray, max_bits: int = MAX_BITS) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among ascending distinct fingerprints, as (smallest of its part,
    other). Breadth first over what is not yet reached, so a dense cluster costs its size times the
    fingerprints outside it, not its size squared."""
    while len(left) > 1:
        front, left, root = left[:1], left[1:], int(left[0])
        while len(front) and len(left):
            step = max(1, (1 << 18) // len(left))
            found = []
            for k in range(0, len(front), step):
                near = _near(left, front[k:k + step], max_bits)
                found.append(left[near])
                left = left[~near]
            front = np.concatenate(found)
            for f in front.tolist():
                yield root, f


def _postings(batches: Iterator[pa.RecordBatch], block: int | None) -> Iterator[tuple[int, int, np.ndarray, bool]]:
    """Postings of batches sorted by key, in parts of at most ``block``: (key, part number, its
    fingerprints, whether it is the whole posting). Postings of one entry are skipped."""
    key, held, part = None, np.empty(0, np.uint64), 0
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(keys):
            continue
        cut = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(keys))
        several = (ends - starts > 1) | (starts == 0) | (ends == len(keys))
        for a, b in zip(starts[several].tolist(), ends[several].tolist()):
            if key is None or keys[a] != key:
                if part or len(held) > 1:
                    yield key, part, held, not part
                key, held, part = int(keys[a]), np.empty(0, np.uint64), 0
            held = np.concatenate([held, fps[a:b]])
            while block and len(held) > block:
                yield key, part, held[:block], False
                held, part = held[block:], part + 1
    if part or len(held) > 1:
        yield key, part, held, not part


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("part", pa.int32())])


def _linked(keyed: DataFrame, max_bits: int, block: int | None) -> DataFrame:
    """``keyed`` (key, fp), dealt by key: links (a, b), and parts of long postings (b, key, part)."""
    from pyspark.sql.pandas.types import from_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple[tuple, int]]:
            for key, part, fps, whole in _postings(batches, block):
                if whole or block is None:
                    for a, b in link(fps, max_bits):
                        yield (signed(a), signed(b), None, None), 32
                else:
                    for f in fps.view(np.int64).tolist():
                        yield (None, f, key, part), 32
        return batched(out(), _EDGE)

    ship(keyed.sparkSession)
    return (keyed.repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, from_arrow_schema(_EDGE)))


def position_keys(fp: Column, positions: list[tuple[int, ...]] = POSITION_SETS) -> Column:
    """The posting keys of a fingerprint: one per position set, the set's number above its bytes."""
    keys = []
    for n, chosen in enumerate(positions):
        parts = [F.shiftleft(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)), 8 * i) for i, p in enumerate(chosen)]
        key = F.lit(n << (8 * len(chosen))).cast("long")
        for p in parts:
            key = key.bitwiseOR(p)
        keys.append(key)
    return F.array(*keys)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``fps`` (distinct ``fp``) -> edges (a, b) whose connected parts are those of all links."""
    if max_bits != MAX_BITS:
        raise ValueError("the position sets are built for four differing bits")
    index = fps.select(F.explode(position_keys(F.col("fp"))).alias("key"), "fp")
    first = stage(_linked(index, max_bits, block), "simhash-links")
    edges = first.where("key is null").select("a", "b")
    parts = first.where("key is not null")
    if parts.isEmpty():
        return edges.distinct()
    last = parts.groupBy("key").agg(F.max("part").alias("last"))
    pair = F.explode(F.sequence(F.lit(0), F.col("last")))
    cells = (parts.join(last, "key").select("key", "part", F.col("b").alias("fp"), pair.alias("other"))
             .select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("key"), "fp"))
    more = _linked(cells, max_bits, None).select("a", "b")
    return edges.unionByName(more).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """Alternating large-star and small-star contraction (Kiveris et al. 2014) until every node
    hangs on the smallest of its component: (node, root), roots themselves left out."""
    def large_star(down: DataFrame) -> DataFrame:
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = both.where("v > u")
        return up.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small_star(down: DataFrame) -> DataFrame:
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        met = down.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return met.unionByName(low.select("u", F.col("m").alias("v"))).distinct()

    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "simhash-parts")
    while True:
        then = stage(small_star(large_star(now)), "simhash-parts")
        # done when each node hangs on one node only, and that one on none
        low = then.groupBy("u").agg(F.count("*").alias("n"))
        if low.where("n > 1").isEmpty() and then.join(then.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return then.select(F.col("u").alias("node"), F.col("v").alias("root"))
        drop_stage(now)
        now = then


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Null and wordless texts have fingerprint zero and link like any other. ``component_id`` is the
    smallest non-null doc_id of the component (null if all are null). Repeated rows come out as
    often as they go in; an empty table gives an empty result; extra columns are ignored."""
    marked = stage(fingerprints(docs, id_col, text_col), "simhash-fingerprints")
    mapped = resolve(marked, block)
    return marked.join(mapped, "fp").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def resolve_parts(marked: DataFrame, block: int = BLOCK) -> DataFrame:
    """``marked`` (with ``fp``) -> (``fp``, ``root``), distinct: the component of each fingerprint.
    Copies are folded before anything is paired, so a group of any size costs one index entry."""
    distinct = stage(marked.select("fp").distinct(), "simhash-distinct")
    parts = connected(links(distinct, MAX_BITS, block))
    return distinct.join(parts, distinct.fp == parts.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def resolve(marked: DataFrame, block: int = BLOCK) -> DataFrame:
    """``marked`` (doc_id, fp) -> per distinct ``fp`` the smallest doc_id of its component."""
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = stage(least.join(resolve_parts(marked, block), "fp"), "simhash-components")
    top = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(top, "root").select("fp", "component_id")
