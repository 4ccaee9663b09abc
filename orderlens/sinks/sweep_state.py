"""The exchange sweep kept up to date (S7, W2): only what has changed is swept again.

The order table lies in partitions by the time of its last update (``part_col``: the day or month that
its UTC text begins with), one row an order. A run stores its result together with a fingerprint of every
partition that it saw, taken from the names, sizes and times of its files. The next run compares the
fingerprints, sweeps the orders of the partitions that differ, and keeps the other rows as they are.
Updates that arrive late change the files of an old partition and are seen by that, where a stored
highest time would miss them; an order that is updated again leaves one partition for another, and both
differ. A change to a return counts once its order's update time has changed, as in the sweep itself.

Runs and their manifest are those of :mod:`orderlens.sinks.files`: a run that fails leaves the one before it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import format_instant_py
from ..operators.exchange import RETURN_FIELDS, sweep_candidates, sweep_rows
from .files import commit_run, latest_run, new_run_id, run_folder

PRINTS = "part string, files long, low long, high long"
COLUMNS = ("externalId", "orderName", "returnId", "returnName", "returnStatus", "returnCreatedAtMillis", "exchangeReturnCount")


def partition_prints(orders: DataFrame, part_col: str) -> DataFrame:
    """One row per partition: the number of its files and a sum over their names, sizes and times. Reads
    no column of the table."""
    files = orders.select(F.col(part_col).cast("string").alias("part"), F.col("_metadata.file_path").alias("path"),
                          F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("time")).distinct()
    mark = F.xxhash64("path", "size", "time")
    return files.groupBy("part").agg(F.count(F.lit(1)).alias("files"), F.sum(mark.bitwiseAND(0xFFFFFFFF)).alias("low"),
                                     F.sum(F.shiftrightunsigned(mark, 32)).alias("high"))


def update_sweep(spark: SparkSession, orders_path: str, part_col: str, returns: DataFrame, return_order, start_ms: int, end_ms: int,
                 state: str, name: str, fields=RETURN_FIELDS, keys: tuple[str, str] = ("id", "order_id")) -> tuple[DataFrame, list[str]]:
    """Bring the sweep ``name`` at ``state`` up to date; returns its rows (those of ``sweep_exchanges``) and
    the partitions that were swept for it. ``name`` stands for one window: another window is another name.
    The driver holds the changed partitions' names, one per day or month at most."""
    start = format_instant_py(_dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=start_ms))
    orders = spark.read.parquet(orders_path)
    part = F.col(part_col).cast("string")
    orders = orders.filter(part >= F.substring(F.lit(start), 1, F.length(part)))
    prints = partition_prints(orders, part_col)
    last = latest_run(spark, state, name)
    if last is None:
        seen = spark.createDataFrame([], PRINTS)
    else:
        folder = run_folder(state, name, last["run_id"])
        seen = spark.read.schema(PRINTS).parquet(f"{folder}/prints")
    new_id = new_run_id()
    folder_now = run_folder(state, name, new_id)
    prints.write.parquet(f"{folder_now}/prints")
    now = spark.read.schema(PRINTS).parquet(f"{folder_now}/prints")
    both = now.join(seen.select("part", F.struct("files", "low", "high").alias("was")), "part", "full")
    changed = sorted(r["part"] for r in both.filter(~F.struct("files", "low", "high").eqNullSafe(F.col("was"))).select("part").collect())
    if not changed and last is not None:
        return spark.read.parquet(f"{folder}/records").select(*COLUMNS), []
    mine = orders.filter(part.isin(*changed))
    cands = sweep_candidates(mine, start)
    own, other = keys
    theirs = returns.join(cands.select(F.col(own).alias(other)), other, "left_semi")
    swept = sweep_rows(cands, theirs, return_order, start_ms, end_ms, fields, keys)
    where = cands.select(F.col(own).alias("_key"), part.alias("_part"))
    rows = swept.join(where, "_key").select("_part", *COLUMNS)
    if last is not None:
        rows = rows.unionByName(spark.read.parquet(f"{folder}/records").filter(~F.col("_part").isin(*changed)))
    rows.write.parquet(f"{folder_now}/records")
    commit_run(spark, state, name, new_id, "parquet")
    return spark.read.parquet(f"{folder_now}/records").select(*COLUMNS), changed
