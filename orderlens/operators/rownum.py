"""Numbering and top-n without a single-task window.

``number_rows`` gives each group a row number in its own window, dealt out by group. What a window
cannot spread -- a group past ``WIDE_GROUP`` rows, or rows without groups -- goes by the two-pass
scheme behind ``RDD.zipWithIndex`` written with DataFrame operators: range-partition on (group,
order), count rows per (group, partition), take cumulative offsets over that small table, and
number each row inside its partition. A group holding a third of all rows is spread over
many range partitions instead of landing in one task.

``top_n_per_group`` is one row number with a limit, which Spark plans with a limit per group
before the shuffle as well: a task sends at most n rows of a group, however large it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written_stage

# Fixed value: rows of a group that one task still sorts; a larger group is spread over ranges.
WIDE_GROUP = 100_000

_IDX_BITS = 33
_IDX_MASK = (1 << _IDX_BITS) - 1


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def number_rows(df: DataFrame, order_cols, group_cols=(), out: str = "row_no",
                num_partitions: int | None = None) -> DataFrame:
    """Dense 1-based numbers in ``order_cols`` order within ``group_cols``.

    ``group_cols + order_cols`` should identify a row (ties are numbered in any order). One count per
    group, with partial sums, tells the groups of more than ``WIDE_GROUP`` rows; where there are none,
    which is the rule, the rows are dealt out by group and numbered there, and a later step by group
    needs no other shuffle. ``num_partitions`` sets the ranges of the others; without it the session's
    adaptive planning does. Pass narrow rows: every column given is sorted."""
    group_cols = list(group_cols)
    if not group_cols:
        return _number_over_ranges(df, order_cols, group_cols, out, num_partitions)
    gnames = [f"__nr_w{i}" for i in range(len(group_cols))]
    named = df.withColumns({g: c for g, c in zip(gnames, _cols(group_cols))})
    sizes = named.groupBy(*gnames).agg(F.count(F.lit(1)).alias("__nr_size")).filter(F.col("__nr_size") > WIDE_GROUP)
    wide = written_stage(sizes.select(*[F.col(g).alias(g + "s") for g in gnames]), "wide-groups")
    window = Window.partitionBy(*_cols(group_cols)).orderBy(*_cols(order_cols))
    number = F.row_number().over(window).cast("long")
    if wide.isEmpty():
        return df.withColumn(out, number)
    # null-safe: the rows whose group is null are a group too; there are few wide groups (rows / WIDE_GROUP at most)
    same = F.lit(True)
    for g in gnames:
        same = same & F.col(g).eqNullSafe(F.col(g + "s"))
    rest = named.join(F.broadcast(wide), same, "left_anti").drop(*gnames).withColumn(out, number)
    spread = named.join(F.broadcast(wide), same, "left_semi").drop(*gnames)
    return rest.unionByName(_number_over_ranges(spread, order_cols, group_cols, out, num_partitions))


def _number_over_ranges(df: DataFrame, order_cols, group_cols, out: str, num_partitions: int | None) -> DataFrame:
    """:func:`number_rows` for groups of any size. The range-sorted, id-tagged rows are written once to a
    folder of this call's own, which the count pass and the numbering pass both read: two independent
    range exchanges would sample different bounds."""
    keys = _cols(group_cols) + _cols(order_cols)
    gnames = [f"__nr_g{i}" for i in range(len(group_cols))]
    tagged = df.withColumns({g: F.col(c) if isinstance(c, str) else c for g, c in zip(gnames, group_cols)})
    dealt = tagged.repartitionByRange(num_partitions, *keys) if num_partitions else tagged.repartitionByRange(*keys)
    ranged = written_stage(
        dealt.sortWithinPartitions(*keys)
        .withColumn("__nr_mid", F.monotonically_increasing_id())
        .withColumn("__nr_pid", F.shiftright("__nr_mid", _IDX_BITS))
        .withColumn("__nr_idx", F.col("__nr_mid").bitwiseAND(F.lit(_IDX_MASK))), "numbered-rows")
    stats = ranged.groupBy(*gnames, "__nr_pid").agg(F.count(F.lit(1)).alias("__nr_cnt"), F.min("__nr_idx").alias("__nr_first"))
    w = Window.partitionBy(*gnames).orderBy("__nr_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("__nr_before", F.coalesce(F.sum("__nr_cnt").over(w), F.lit(0)))
    # null-safe on the groups: rows whose group is null are numbered too
    stats = stats.select(*[F.col(g).alias(g + "s") for g in gnames], F.col("__nr_pid").alias("__nr_pids"), "__nr_first", "__nr_before")
    same = F.col("__nr_pid") == F.col("__nr_pids")
    for g in gnames:
        same = same & F.col(g).eqNullSafe(F.col(g + "s"))
    joined = ranged.join(stats, same, "inner").drop("__nr_pids", *[g + "s" for g in gnames])
    return joined.withColumn(out, (F.col("__nr_before") + F.col("__nr_idx") - F.col("__nr_first") + 1).cast("long")).drop(
        "__nr_mid", "__nr_pid", "__nr_idx", "__nr_first", "__nr_before", *gnames
    )


def top_n_per_group(df: DataFrame, group_cols, order_cols, n: int, out: str | None = None) -> DataFrame:
    """First ``n`` rows per group in ``order_cols`` order (asc unless Columns say otherwise).

    ``out`` (optional) receives the 1-based position within the group."""
    pos = out or "__nr_rn"
    w = Window.partitionBy(*_cols(list(group_cols))).orderBy(*_cols(order_cols))
    res = df.withColumn(pos, F.row_number().over(w)).filter(F.col(pos) <= n)
    return res if out else res.drop(pos)


def keep_last(df: DataFrame, key_cols, seq_col: str) -> DataFrame:
    """A5: one row per key, the one with the highest ``seq_col`` ("later row wins"). A max_by per
    key: partial aggregation, so a hot key is reduced map-side before the shuffle."""
    others = [c for c in df.columns if c not in key_cols]
    agg = df.groupBy(*key_cols).agg(F.max_by(F.struct(*others), F.col(seq_col)).alias("__kl"))
    return agg.select(*key_cols, "__kl.*")
