"""Exact top-k by inner product with MaxScore over blocks of vectors.

A dimension is a term and its posting the components of a block's vectors; the least and the most that
a term adds to a query's score within the block are its bounds. With the k-th score so far as
threshold the terms, widest bounds first, are split: behind the essential ones stand those that cannot
lift a vector to the threshold which is at its least in all essential ones. Essential postings are
traversed for all vectors; the others are probed a few at a time, only for vectors that are still
competitive, and the threshold rises as it goes.

Blocks (shards) are separate tasks. Each query first meets one block, its home; the k-th score found
there is the threshold that it brings to all other blocks, and a block whose bounds together stay
below it is passed over whole. The k best of all blocks merge."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import ship, stage

SCALE, TOP, EVERY = 256, 5, 50
#: Vectors in a candidate block and in a query block.
BLOCK, QUERIES = 8192, 8192
#: Terms probed between two looks at which vectors are still competitive.
STRIDE = 8


@dataclass
class Work:
    """What queries against blocks came to: blocks passed over, essential terms of all terms, and the
    components read (traversed or probed) of all components."""

    passed: int = 0
    essential: int = 0
    terms: int = 0
    read: int = 0
    components: int = 0


def _matrix(lists: list, dims: int) -> np.ndarray:
    """Rows of equal length; a missing component is zero."""
    out = np.zeros((len(lists), dims), np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _kth(scores: np.ndarray, k: int) -> float:
    """The k-th largest; nothing is known of it while there are fewer."""
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def _added(block: np.ndarray, alive: np.ndarray, terms: np.ndarray, query: np.ndarray) -> np.ndarray:
    """What the terms add to the scores of the vectors that are left; whole postings while those are many."""
    if 4 * len(alive) > len(block):
        return (block[:, terms] @ query[terms])[alive]
    return block[np.ix_(alive, terms)] @ query[terms]


def best(query: np.ndarray, ids: np.ndarray, own: int, block: np.ndarray, low: np.ndarray, high: np.ndarray, k: int,
         floor: float = -np.inf, work: Work | None = None) -> list[tuple[int, int]]:
    """The (score, id) of a block that can be among a query's k best, best first and ties to smaller
    ids; ``ids`` ascend. ``floor``: a score that k candidates of the query are known to reach."""
    work = work or Work()
    alive = np.flatnonzero(ids != own)
    if not len(alive):
        return []
    a, b = query * low, query * high
    least, most = np.minimum(a, b), np.maximum(a, b)  # that a term adds in this block
    terms = np.argsort(least - most, kind="stable")  # widest first
    above = np.append(np.cumsum(most[terms][::-1])[::-1], 0)  # most that the terms from here on add
    under = np.append(np.cumsum(least[terms][::-1])[::-1], 0)
    work.terms += len(terms)
    work.components += len(terms) * len(alive)
    if above[0] < floor:
        work.passed += 1
        return []
    lead = terms[:STRIDE]
    strong = _added(block, alive, lead, query)
    seeds = alive[np.argpartition(strong, max(0, len(alive) - 4 * k))[-4 * k:]]
    threshold = max(floor, _kth(block[seeds] @ query, k))
    # most that a vector reaches which is at its least in the terms before: falls from term to term
    reach = np.append(0, np.cumsum(least[terms])) + above
    at = int(np.searchsorted(-reach, -threshold, "right"))  # the first place where it is below
    at = min(at, len(terms))
    work.essential += at
    work.read += at * len(alive)
    first = terms[:at]
    score = _added(block, alive, first, query) if at else np.zeros(len(alive))
    while True:
        threshold = max(threshold, _kth(score + under[at], k))
        keep = score + above[at] >= threshold  # equal scores stay: the id decides
        alive, score = alive[keep], score[keep]
        if at >= len(terms) or not len(alive):
            break
        more = terms[at:at + STRIDE]
        score = score + _added(block, alive, more, query)
        work.read += len(more) * len(alive)
        at += len(more)
    order = np.lexsort((ids[alive], -score))[:k]
    return [(int(score[i]), int(ids[alive[i]])) for i in order]


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): whole-number components of the rows that take part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull()).where(finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("v")))


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k best candidates, ties to the
    smaller id. Queries are the rows whose id is divisible by ``every``; rows of one id are one query,
    with the best scores of any of its vectors.

    Rows with a null id, and vectors null or holding a null or non-finite component, take no part.
    Vectors of unequal length count as padded with zeros; an empty one scores zero. A query's own
    id is never its candidate; otherwise repeated rows are candidates each for itself. Scores must
    fit in 64 bits. The join is of query blocks with candidate blocks, every block of bounded size."""
    rows = stage(quantised(vectors, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    blocks = max(1, math.ceil(rows.count() / block))
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "v").distinct()
    asked = stage(asked.withColumn("dealt", F.xxhash64("vec_id", "v")), "topk-queries")
    groups = max(1, math.ceil(asked.count() / queries))
    asked = asked.select("vec_id", "v", F.pmod("dealt", F.lit(groups)).cast("int").alias("g")).withColumn("home", F.pmod("g", F.lit(blocks)))
    rows = rows.select("vec_id", "v", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("b"))

    def cell(candidates: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(wanted):
            dims = max(1, max(map(len, candidates.v)), max(map(len, wanted.v)))
            candidates = candidates.sort_values("vec_id", kind="stable")
            ids, m, q = candidates.vec_id.to_numpy(), _matrix(list(candidates.v), dims), _matrix(list(wanted.v), dims)
            top = float(np.abs(m).max(initial=0)) * float(np.abs(q).max(initial=0)) * dims
            if top < 2.0 ** 53:  # then doubles hold every partial sum exactly
                m, q = m.astype(np.float64), q.astype(np.float64)
            m = np.asfortranarray(m)  # postings end to end
            low, high = m.min(axis=0), m.max(axis=0)
            for own, x, floor in zip(wanted.vec_id.to_numpy(), q, wanted.floor.to_numpy()):
                out += [(own, i, s) for s, i in best(x, ids, own, m, low, high, k, -np.inf if np.isnan(floor) else floor)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInPandas(cell, "query_id long, vec_id long, score long")

    ship(vectors.sparkSession)
    unknown = F.lit(float("nan")).alias("floor")
    pairs = asked.select(F.col("g").alias("group"), F.col("home").alias("b")).distinct()  # one row per query block
    own = rows.join(F.broadcast(pairs), "b").select("vec_id", "v", "b", F.col("group").alias("g"))
    at_home = stage(met(own, asked.select("vec_id", "v", "g", F.col("home").alias("b"), unknown)), "topk-home")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = at_home.withColumn("rank", F.row_number().over(order))
    # scores beyond 2^53 lose digits as a threshold, so it is set a little lower
    floors = ranked.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), (F.col("score").cast("double") - F.abs("score") * 1e-15).alias("known"))
    spread = lambda name, n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    home = F.pmod("g", F.lit(blocks))
    left = rows.select("vec_id", "v", "b", spread("g", groups)).where(F.col("b") != home)
    right = asked.join(floors, "vec_id", "left").select("vec_id", "v", "g", F.coalesce("known", F.lit(float("nan"))).alias("floor"), spread("b", blocks)) \
        .where(F.col("b") != home)
    found = at_home.unionByName(met(left, right)) if blocks > 1 else at_home
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
