"""Sharding by best-fit-decreasing bin packing of indivisible groups (equal texts).

Groups are packed whole. Those that hold a noticeable part of all bytes are items of their own;
there can be no more than ``FINE`` of them. The many small ones are first pooled by hash into
``FINE`` items, so what the driver packs has a fixed bound while groups, rows and bytes grow."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import stage

#: Pools of small groups; a group with over 1/FINE of all bytes is an item by itself.
FINE = 4096
#: Rows that one numbering task orders.
ROWS_A_RANGE = 50_000


@dataclass
class _Node:
    key: tuple[int, int]
    left: _Node | None = None
    right: _Node | None = None
    height: int = 1


def _height(n: _Node | None) -> int:
    return n.height if n else 0


def _lean(n: _Node) -> int:
    return _height(n.left) - _height(n.right)


def _measured(n: _Node) -> _Node:
    n.height = 1 + max(_height(n.left), _height(n.right))
    return n


def _turn_right(n: _Node) -> _Node:
    top = n.left
    n.left, top.right = top.right, n
    _measured(n)
    return _measured(top)


def _turn_left(n: _Node) -> _Node:
    top = n.right
    n.right, top.left = top.left, n
    _measured(n)
    return _measured(top)


def _even(n: _Node) -> _Node:
    _measured(n)
    if _lean(n) > 1:
        if _lean(n.left) < 0:
            n.left = _turn_left(n.left)
        return _turn_right(n)
    if _lean(n) < -1:
        if _lean(n.right) > 0:
            n.right = _turn_right(n.right)
        return _turn_left(n)
    return n


class Bins:
    """A height-balanced tree of (remaining capacity, bin)."""

    def __init__(self):
        self.root: _Node | None = None

    def add(self, key: tuple[int, int]) -> None:
        def put(n: _Node | None) -> _Node:
            if n is None:
                return _Node(key)
            if key < n.key:
                n.left = put(n.left)
            else:
                n.right = put(n.right)
            return _even(n)

        self.root = put(self.root)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least capacity that still holds ``need``."""
        n, best = self.root, None
        while n:
            if n.key >= (need, -1):
                best, n = n.key, n.left
            else:
                n = n.right
        if best is not None:
            self.root = self._without(self.root, best)
        return best

    def _without(self, n: _Node, key: tuple[int, int]) -> _Node | None:
        if key < n.key:
            n.left = self._without(n.left, key)
        elif key > n.key:
            n.right = self._without(n.right, key)
        elif n.left and n.right:
            low = n.right
            while low.left:
                low = low.left
            n.key = low.key
            n.right = self._without(n.right, low.key)
        else:
            return n.left or n.right
        return _even(n)


def best_fit_decreasing(items: list[tuple[int, int]], capacity: int) -> list[int]:
    """Bin of each (size, tie-breaker), in the order given; as many bins as come out."""
    tree, out, bins = Bins(), [0] * len(items), 0
    for i in sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][1])):
        size = items[i][0]
        room = tree.take(size)
        if room is None:
            room, bins = (max(capacity, size), bins), bins + 1
        out[i] = room[1]
        tree.add((room[0] - size, room[1]))
    return out


def pack_into(items: list[tuple[int, int]], shards: int) -> list[int]:
    """Shards of the items: an item that is more than an even share of what is left gets a shard to
    itself; the others go under the smallest capacity at which the remaining shards are enough."""
    out, left = [0] * len(items), sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][1]))
    rest, alone = sum(s for s, _ in items), 0
    while alone < min(shards - 1, len(left)) and items[left[alone]][0] * (shards - alone) > rest:
        out[left[alone]], rest = alone, rest - items[left[alone]][0]
        alone += 1
    left, free = left[alone:], shards - alone
    own = [items[i] for i in left]
    low = max([math.ceil(rest / free), *(s for s, _ in own)], default=1)
    high, best = max(2 * low, 1), [0] * len(own)  # best fit never needs more than twice the even share
    while low <= high:
        capacity = (low + high) // 2
        got = best_fit_decreasing(own, capacity)
        if max(got, default=0) < free:
            best, high = got, capacity - 1
        else:
            low = capacity + 1
    for i, bin_ in zip(left, best):
        out[i] = alone + bin_
    return out


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", fine: int = FINE,
          rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """One row per input row: ``doc_id``, ``size`` (bytes of the text plus one), ``text_crc32``,
    ``law`` ('bytes'), ``shard``, ``slot`` (gapless from 0 in each shard), ``grown_shard`` (null).

    Equal texts share a shard, null texts one group of their own; so a group with more than its
    share of all bytes makes its shard larger than the others. Repeated rows are rows of their own;
    extra columns are ignored; an empty table gives an empty result. The driver gets at most
    2 x ``fine`` (item, bytes) rows."""
    text = F.col(text_col).cast("string")
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(text, 256), F.lit("-")).alias("text_key"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(narrow, "shard-rows")
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    pool = F.pmod(F.xxhash64("text_key"), F.lit(fine)).cast("string")
    item = F.when(F.col("bytes") * fine >= total, F.col("text_key")).otherwise(pool)
    items = groups.groupBy(item.alias("item")).agg(F.sum("bytes").alias("bytes")).orderBy("item").collect()
    placed = pack_into([(r.bytes, i) for i, r in enumerate(items)], shards)
    spark = docs.sparkSession
    where = spark.createDataFrame([(r.item, s) for r, s in zip(items, placed)], "item string, shard int")
    own = where.where(F.length("item") == 64).select(F.col("item").alias("text_key"), F.col("shard").alias("own"))
    pools = where.where((F.length("item") != 64) & (F.col("item") != "-")).select(F.col("item").alias("pool"), F.col("shard").alias("pooled"))
    own = own.unionByName(where.where("item = '-'").select(F.col("item").alias("text_key"), F.col("shard").alias("own")))
    ranges = max(1, math.ceil(count / rows_a_range / shards)) * 4
    dealt = (rows.join(F.broadcast(own), "text_key", "left")
             .withColumn("pool", pool).join(F.broadcast(pools), "pool", "left")
             .select("doc_id", "size", "text_crc32", F.coalesce("own", "pooled").alias("shard"), "row",
                     F.pmod(F.xxhash64("row"), F.lit(ranges)).cast("int").alias("range")))
    return number(dealt).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def number(dealt: DataFrame) -> DataFrame:
    """Adds ``slot``: rows are ordered within (shard, range), and each range starts where the counts
    of the ranges before it end. Only the counts, one row per range, meet in one place a shard."""
    from pyspark.sql import Window

    counts = dealt.groupBy("shard", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "range").orderBy("doc_id", "row")
    local = dealt.withColumn("local", F.row_number().over(order) - 1)
    return local.join(starts, ["shard", "range"]).withColumn("slot", (F.col("start") + F.col("local")).cast("long"))
