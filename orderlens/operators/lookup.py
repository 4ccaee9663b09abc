"""Id lookups: point reads (S6), found / missing split (J1), batches (U2), reconcile.

The remote service resolved ids 250 at a time; here the whole requested set is one join on
the canonical id. Requested ids are deduplicated first (a partial aggregation, so a hot id
costs nothing), which also bounds every join key to the few spellings of one order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import to_order_gid_lookup, to_order_gid_state
from ..functions.text import trimmed
from ..session import written_stage
from ..sources.gate import behind
from .rownum import number_rows

# Ids per remote call in the original (kept as the default batch sizes).
LOOKUP_BATCH = 250
STATE_BATCH = 50


def orders_by_id(orders: DataFrame, ids: DataFrame, id_col: str = "id", request_col: str = "requested_id") -> DataFrame:
    """Exactly the requested orders, by primary (gid) id; blank or unknown ids match nothing.

    The distinct keys are written first, so Spark knows their size when it plans the join: a list within
    its broadcast bound goes to the orders, which then are read where they lie. For longer lists keep the
    orders in buckets by id (:func:`save_bucketed`): only the requests are dealt out then."""
    keys = ids.select(to_order_gid_lookup(F.col(request_col)).alias("_gid")).filter(F.col("_gid").isNotNull()).distinct()
    keys = written_stage(keys, "requested-ids")
    return orders.join(keys, orders[id_col] == keys["_gid"], "left_semi")


def save_bucketed(orders: DataFrame, table: str, buckets: int, id_col: str = "id", path: str | None = None) -> None:
    """Store orders as a catalogue table (at ``path``, else in the warehouse) in ``buckets`` by id, each
    sorted by it. Point reads (S6) and found / missing splits (J1) against it then leave the orders
    where they are."""
    writer = orders.repartition(buckets, id_col).write.bucketBy(buckets, id_col).sortBy(id_col).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def requested_ids(requests: DataFrame, request_col: str = "requested_id", position_col: str | None = None) -> DataFrame:
    """Blank ids dropped, duplicates (by trimmed text) collapsed to their first position."""
    pos = F.col(position_col) if position_col else F.lit(0).cast("long")
    return (requests.select(trimmed(F.col(request_col)).alias("requested_id"), pos.alias("_pos"))
            .filter(F.col("requested_id") != "")
            .groupBy("requested_id").agg(F.min("_pos").alias("first_position")))


def split_found_missing(requests: DataFrame, primary: DataFrame, lookup_ok: bool = True,
                        request_col: str = "requested_id", id_col: str = "id", status: DataFrame | None = None) -> DataFrame:
    """One row per distinct requested id (as requested), ``found`` by canonical gid.

    A failed primary read yields no rows at all: a failed lookup must never classify an id as missing.
    It is told by ``status``, the lookup's one-row frame (column ``ok``), or by ``lookup_ok=False``.
    Empty input -> empty result."""
    # never null here; said so, or the join's null check would be evaluated again on every raw request
    req = requested_ids(requests, request_col).withColumn("canonical_id", F.coalesce(to_order_gid_lookup(F.col("requested_id")), F.lit("")))
    known = primary.select(F.col(id_col).alias("canonical_id")).distinct().withColumn("found", F.lit(True))
    out = req.join(known, "canonical_id", "left").select(
        "requested_id", "canonical_id", F.coalesce(F.col("found"), F.lit(False)).alias("found"))
    return behind(out, status) if lookup_ok else out.limit(0)


def found_ids(split: DataFrame) -> DataFrame:
    return split.filter(F.col("found")).select("requested_id")


def missing_ids(split: DataFrame) -> DataFrame:
    return split.filter(~F.col("found")).select("requested_id")


def batch_ids(requests: DataFrame, size: int = LOOKUP_BATCH, request_col: str = "requested_id",
              position_col: str = "position", state_form: bool = False) -> DataFrame:
    """Distinct canonical ids in first-occurrence order, cut into consecutive batches.

    Output: canonical_id, id_no (1-based), batch_no (0-based). Numbering is the two-pass
    distributed scheme (no single-task window)."""
    canon = to_order_gid_state if state_form else to_order_gid_lookup
    firsts = (requests.select(canon(F.col(request_col)).alias("canonical_id"), F.col(position_col).alias("_pos"))
              .filter(F.col("canonical_id").isNotNull())
              .groupBy("canonical_id").agg(F.min("_pos").alias("_first")))
    numbered = number_rows(firsts, ["_first", "canonical_id"], out="id_no")
    return numbered.select("canonical_id", "id_no", F.floor((F.col("id_no") - 1) / size).cast("long").alias("batch_no"))


def reconcile_ids(left: DataFrame, right: DataFrame, left_col: str = "left_id", right_col: str = "right_id") -> DataFrame:
    """Two id sets compared on the canonical gid: ``matched``, ``missing_right`` (only
    left has it) or ``missing_left`` (only right has it)."""
    lft = left.select(to_order_gid_lookup(F.col(left_col)).alias("canonical_id")).filter(F.col("canonical_id").isNotNull()).distinct()
    rgt = right.select(to_order_gid_lookup(F.col(right_col)).alias("canonical_id")).filter(F.col("canonical_id").isNotNull()).distinct()
    j = lft.withColumn("_l", F.lit(True)).join(rgt.withColumn("_r", F.lit(True)), "canonical_id", "full_outer")
    state = (F.when(F.col("_l") & F.col("_r"), F.lit("matched"))
             .when(F.col("_l").isNotNull(), F.lit("missing_right"))
             .otherwise(F.lit("missing_left")))
    return j.select("canonical_id", state.alias("state"))


#: Buckets that two id sets are compared in.
DIGEST_BUCKETS = 4096


def id_digests(ids: DataFrame, id_col: str, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """Per bucket of the canonical id: how many there are, and two 64-bit hashes of each added up (in
    halves, which cannot overflow). The sums do not depend on order, so they combine before the shuffle
    and one row a bucket and task leaves it."""
    own = ids.select(to_order_gid_lookup(F.col(id_col)).alias("canonical_id")).filter(F.col("canonical_id").isNotNull())
    hashes = [F.xxhash64("canonical_id"), F.xxhash64(F.lit(1), "canonical_id")]
    halves = [h.bitwiseAND(0xFFFFFFFF) if low else F.shiftrightunsigned(h, 32) for h in hashes for low in (True, False)]
    return own.groupBy(F.pmod(hashes[0], F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"h{k}") for k, h in enumerate(halves)])


def changed_buckets(left: DataFrame, right: DataFrame, left_col: str = "left_id", right_col: str = "right_id",
                    buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """``bucket``: those whose digests differ, or that only one side has."""
    a, b = id_digests(left, left_col, buckets), id_digests(right, right_col, buckets)
    parts = [c for c in a.columns if c != "bucket"]
    both = a.select("bucket", F.struct(*parts).alias("a")).join(b.select("bucket", F.struct(*parts).alias("b")), "bucket", "full")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("bucket")


def id_differences(left: DataFrame, right: DataFrame, left_col: str = "left_id", right_col: str = "right_id",
                   buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """E1 for two sets that should be the same: the rows of :func:`reconcile_ids` that are not
    ``matched``. Equal digests mean equal ids (repeats included; two 64-bit hashes), so only ids of
    differing buckets meet in a join. Sets that differ only in repeats give no rows."""
    differ = written_stage(changed_buckets(left, right, left_col, right_col, buckets), "changed-buckets")

    def mine(df: DataFrame, col: str) -> DataFrame:
        bucket = F.pmod(F.xxhash64(to_order_gid_lookup(F.col(col))), F.lit(buckets))
        # ``buckets`` rows at most
        return df.select(col).withColumn("bucket", bucket).join(F.broadcast(differ), "bucket", "left_semi").select(col)
    both = reconcile_ids(mine(left, left_col), mine(right, right_col), left_col, right_col)
    return both.filter("state != 'matched'")


def confirm_missing(reconciled: DataFrame, primary: DataFrame, lookup_ok: bool = True, id_col: str = "id") -> DataFrame:
    """E1 second step: ids the extraction (right side) lacks are re-checked by point lookup
    against the primary store (J1); ``confirmed_missing`` is false when it holds the order."""
    miss = reconciled.filter(F.col("state") == "missing_right").select(F.col("canonical_id").alias("requested_id"))
    split = split_found_missing(miss, primary, lookup_ok, id_col=id_col)
    return split.select(F.col("canonical_id"), (~F.col("found")).alias("confirmed_missing"))
